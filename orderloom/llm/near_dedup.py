"""Near-duplicate documents: SuperMinHash signatures, banding, verification, components.

1. A document is the set of its ``WORDS``-word shingles (64-bit hashes). Equal
   sets are one class from here on, under the smallest id.
2. SuperMinHash: every shingle draws one random permutation of the slots; its
   j-th draw offers j + r (0 <= r < 1) to the slot that is j-th in its
   permutation, a slot keeps the smallest offer. Draws go layer by layer and a
   document stops as soon as all of its slots hold a value below the next
   layer, which for all but short documents is the first.
3. ``BANDS`` bands of ``ROWS`` slots each give bucket keys. A bucket whose members
   all share an earlier bucket as well adds nothing and is left out. At the
   linking similarity of 0.85 two sets share no bucket with probability
   (1 - 0.85**4)**16 < 1e-5.
4. Verification on the full sets, inside the buckets. First every member meets the
   smallest one of its bucket; what links is joined into components. Then, only in
   buckets that still hold several components, the members that are not with
   the smallest one meet all members. Both steps cut a bucket into blocks of at most
   about ``BLOCK`` members on either side, one pair of blocks at a time, and
   return a spanning forest of the links found, so neither rows out nor
   memory follow the square of a bucket.

Defined cases: null or empty texts and those without words have the empty
set and link with nothing; texts of fewer words than a shingle have one
element; rows with one id are one document (it has the links of all its
rows), null ids count as one document with the largest id; an empty table
gives an empty result; other columns are ignored. ``drop_near_duplicates`` keeps them, and
takes every row as a document of its own, whatever its id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import BATCH_ROWS, as_doc, id_order, map_texts, per_worker, stored, undoc
from orderloom.llm.components import connected_components
from orderloom.operators.joins import bounded_broadcast

WORDS = 5
PERCENT = 85             # links: 100 * intersection >= PERCENT * union
BANDS, ROWS = 16, 4
SLOTS = BANDS * ROWS
BLOCK = 256
SIGNED = 200_000
CACHED_WORDS = 300_000
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) > CACHED_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


def _hashes() -> WordHashes:
    return per_worker("hashes", WordHashes)


def shingle_set(text: bytes, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes. bytes.lower and bytes.split are ASCII only, as needed here."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    size = min(words, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for j in range(size):
        h = mix(h ^ w[j:j + len(h)]) + np.uint64(j)
    return np.unique(h)


def super_minhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """(len(sets), slots) uint64: layer in the top byte, random part below; all ones if the set is empty."""
    sizes = np.array([len(s) for s in sets])
    out = np.full(len(sets) * slots, np.iinfo(np.uint64).max, np.uint64)
    row = np.repeat(np.arange(len(sets)), sizes)
    h = np.concatenate([*sets, np.zeros(0, np.uint64)])
    perm = None
    for layer in range(slots):
        if not len(h):
            break
        pick = mix(h + np.uint64((2 * layer + 1) * _STEP % 2**64))
        value = mix(h + np.uint64((2 * layer + 2) * _STEP % 2**64))
        k = layer + ((pick >> np.uint64(32)) * np.uint64(slots - layer) >> np.uint64(32)).astype(np.int64)
        if layer:
            each = np.arange(len(h))
            slot = perm[each, k]
            perm[each, k] = perm[:, layer]
            perm[:, layer] = slot
        else:
            slot = k
        np.minimum.at(out, row * slots + slot, (np.uint64(layer) << np.uint64(56)) | (value >> np.uint64(8)))
        # early stopping: a later layer cannot lower a slot that holds a value of this one
        open_rows = (out.reshape(-1, slots) >> np.uint64(56)).max(axis=1) > layer
        go_on = open_rows[row]
        if not go_on.any():
            break
        if layer == 0:
            perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (int(go_on.sum()), 1))
            each, first = np.arange(len(perm)), k[go_on]
            perm[each, first] = 0
            perm[:, 0] = first
        else:
            perm = perm[go_on]
        h, row = h[go_on], row[go_on]
    return out.reshape(-1, slots)


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    keys = np.zeros((len(signatures), bands), np.uint64)
    for r in range(rows):
        keys = mix(keys ^ signatures[:, r::rows][:, :bands]) + np.uint64(r + 1)
    return keys.view(np.int64)


def _parts(sets: list[np.ndarray]):
    """Runs of sets of at most ``SIGNED`` elements, or one larger set."""
    part, held = [], 0
    for s in sets:
        if part and held + len(s) > SIGNED:
            yield part
            part, held = [], 0
        part.append(s)
        held += len(s)
    yield part


def signatures(docs: DataFrame, text_col: str, words: int = WORDS) -> DataFrame:
    """``doc`` with n_shingles, fp (128-bit name of the set) and keys (one per band; null for an empty set)."""

    def start():
        hashes = _hashes()

        def work(texts):
            sets = [shingle_set(t, hashes, words) for t in texts]
            keys = np.concatenate([band_keys(super_minhash(some)) for some in _parts(sets)])
            empty = np.array([not len(s) for s in sets])
            return [pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([None if e else k for e, k in zip(empty, keys)], pa.list_(pa.int64()))]

        return work

    return map_texts(docs, text_col, "n_shingles bigint, fp binary, keys array<bigint>", start)


def _members(classes: DataFrame) -> DataFrame:
    """(band, key, rep, fp, size, center) of the buckets with several members that no earlier band covers.

    ``classes``: rep, fp, keys. Nearly all buckets have one member: they are told by a narrow count, and
    only what is left meets the other keys of its members.
    """
    each = classes.select("rep", "fp", F.posexplode("keys").alias("band", "key"))
    shared = stored(each.groupBy("band", "key").agg(F.count("*").alias("size"), F.min("rep").alias("center")).where("size > 1"), "shared")
    held = stored(each.join(shared, ["band", "key"]), "held")
    # only the keys of earlier bands matter
    earlier = [F.when(F.col("band") > j, F.col("keys")[j]) for j in range(BANDS - 1)]
    ends = held.select("fp", "band", "key").join(classes.select("fp", "keys"), "fp").groupBy("band", "key").agg(
        *[f(c).alias(f"{name}{j}") for j, c in enumerate(earlier) for name, f in (("low", F.min), ("high", F.max))])
    covered = F.lit(False)
    for j in range(BANDS - 1):
        covered = covered | F.coalesce(F.col(f"low{j}") == F.col(f"high{j}"), F.lit(False))
    return held.join(ends.where(~covered).select("band", "key"), ["band", "key"], "left_semi")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def block_links(left: list, right: list, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between members (rep, label, set) of two blocks.

    Pairs that have one label already, or have got one here, need no further check.
    """
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    if len(left) * len(right) <= 4:
        pairs = ((x, y) for x in left for y in right)
        for (a, la, sa), (b, lb, sb) in pairs:
            if a != b and root(la) != root(lb) and _linked(sa, sb, percent):
                parent[root(la)] = root(lb)
                out.append((a, b))
        return out
    sizes = np.array([len(s) for _, _, s in right])
    names, inverse = np.unique(np.concatenate([s for _, _, s in right]), return_inverse=True)
    begin = np.cumsum(sizes) - sizes
    mark = np.zeros(len(names) + 1, bool)
    for a, la, sa in left:
        at = np.searchsorted(names, sa)
        at = at[names[np.minimum(at, len(names) - 1)] == sa]
        mark[at] = True
        both = np.add.reduceat(mark[inverse].astype(np.int32), begin)
        mark[at] = False
        for i in np.flatnonzero(100 * both >= percent * (sizes + len(sa) - both)):
            b, lb, _ = right[i]
            if a != b and root(la) != root(lb):
                parent[root(la)] = root(lb)
                out.append((a, b))
    return out


def _verified(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found in blocks. ``members``: band, key, i, j, is_left, rep, label, shingles."""

    def run(batches):
        held, left, right, out = None, [], [], []

        def close():
            out.extend(block_links(left, right, percent))
            left.clear()
            right.clear()

        for batch in batches:
            names = [c.to_pylist() for c in batch.columns]
            for band, key, i, j, is_left, rep, label, shingles in zip(*names):
                if held != (band, key, i, j):
                    close()
                    held = (band, key, i, j)
                (left if is_left else right).append((rep, label, np.frombuffer(shingles, np.uint64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["a", "b"])
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["a", "b"])

    members.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return (members.select("band", "key", "i", "j", "is_left", "rep", "label", "shingles")
            .repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j")
            .mapInArrow(run, "a bigint, b bigint"))


def _blocked(members: DataFrame, n_left, n_right) -> DataFrame:
    """Deal the members of each bucket into pairs of blocks: left ones to every right block, right ones to every left block."""
    own = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))
    blocks = members.withColumns({"n_left": n_left, "n_right": n_right})
    left = blocks.where("in_left").withColumn("i", own(F.col("n_left"))).withColumn("j", every(F.col("n_right"))).withColumn("is_left", F.lit(True))
    right = blocks.where("in_right").withColumn("j", own(F.col("n_right"))).withColumn("i", every(F.col("n_left"))).withColumn("is_left", F.lit(False))
    return left.unionByName(right)


def _sets(docs: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """(rep, fp, shingles) of the documents in ``reps`` (rep, fp); text is read again, not kept."""
    # the texts of all documents stay where they are as long as the ids wanted are proven to be few
    wanted = bounded_broadcast(reps.select("rep").distinct())
    texts = docs.select(id_order(F.col("id")).alias("rep"), "text").join(wanted, "rep", "left_semi")

    def start():
        hashes = _hashes()

        def work(texts):
            sets = [shingle_set(t, hashes, words).tobytes() for t in texts]
            return [pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())]

        return work

    found = map_texts(texts, "text", "fp binary, shingles binary", start).select("doc.rep", "fp", "shingles")
    # a document's other rows are other sets; one row of each set is enough
    return found.join(reps, ["rep", "fp"], "left_semi").dropDuplicates(["rep", "fp"])


def near_duplicates(docs: DataFrame, *, percent: int = PERCENT, words: int = WORDS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component): a row for each row of ``docs``; a null id is ``NULL_ID``.

    ``component`` is the smallest id reachable over links, the own id included.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = signatures(docs, "text", words)
    table = stored(signed.select(id_order(F.col("doc.id")).alias("id"), "n_shingles", "fp", "keys"), "signatures")
    component = connected_components(links(docs, table, percent, words)).withColumnRenamed("node", "id")
    return (table.select("id", "n_shingles").join(component, "id", "left")
            .select("id", "n_shingles", F.coalesce("component", "id").alias("component")))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group stays, with its own columns: the one with the smallest id.

    Here every row is a document: rows that share an id, or have none, link by their own
    texts only. Rows of a group with one id go by a hash of the text, equal ones by their place.
    """
    numbered = stored(as_doc(docs).withColumn("row", F.monotonically_increasing_id()), "numbered")
    rows = numbered.select("row", F.col(f"doc.`{id_col}`").alias("id"), F.col(f"doc.`{text_col}`").alias("text"))
    found = stored(near_duplicates(rows, id_col="row", text_col="text", **options).select(F.col("id").alias("row"), "component"), "groups")
    first = F.min(F.struct(id_order(F.col("id")).alias("id"), "hash", "row")).alias("first")
    names = rows.select("row", "id", F.xxhash64("text").alias("hash"))
    groups = stored(found.join(names, "row").groupBy("component").agg(first, F.count("*").alias("size"))
                    .where("size > 1").select("component", F.col("first.row").alias("kept")), "kept")
    # the row that names a group is in it
    members = found.where("row <> component").select("row").union(groups.select("component"))
    gone = stored(members.join(groups.select(F.col("kept").alias("row")), "row", "left_anti"), "gone")
    return undoc(numbered.join(gone, "row", "left_anti"), docs)


def links(docs: DataFrame, table: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """(a, b) links that connect what is linked: copies to their class, and verified forests.

    ``docs``: id, text; ``table``: id, n_shingles, fp, keys.
    """
    full = table.where(F.col("fp").isNotNull())
    classes = stored(full.groupBy("fp").agg(F.min(F.struct("id", "keys")).alias("first"))
                     .select("fp", F.col("first.id").alias("rep"), F.col("first.keys").alias("keys")), "classes")
    copies = (full.select("id", "fp").join(classes.select("fp", "rep"), "fp").where("id <> rep")
              .select(F.col("id").alias("a"), F.col("rep").alias("b")))
    members = stored(_members(classes), "members")
    sets = stored(_sets(docs, stored(members.select("rep", "fp").distinct(), "wanted"), words), "sets")

    whole = members.join(sets, ["rep", "fp"]).withColumns({
        "label": F.col("rep"), "in_left": F.col("rep") == F.col("center"), "in_right": F.col("rep") != F.col("center")})
    near = stored(_verified(_blocked(whole, F.lit(1), F.ceil(F.col("size") / BLOCK)), percent), "center-links")

    # what is not yet with the smallest member of its bucket meets all members
    label = connected_components(near).select(F.col("node").alias("rep"), F.col("component").alias("label"))
    centers = label.select(F.col("rep").alias("center"), F.col("label").alias("center_label"))
    labelled = (members.where("size > 2").join(label, "rep", "left").join(centers, "center", "left")
                .withColumns({"label": F.coalesce("label", "rep"), "center_label": F.coalesce("center_label", "center")})
                .withColumn("in_left", F.col("label") != F.col("center_label")))
    labelled = stored(labelled, "labelled")
    rest = labelled.groupBy("band", "key").agg(F.sum(F.col("in_left").cast("long")).alias("n_rest")).where("n_rest > 0")
    unsettled = labelled.join(rest, ["band", "key"]).withColumn("in_right", F.lit(True)).join(sets, ["rep", "fp"])
    far = stored(_verified(_blocked(unsettled, F.ceil(F.col("n_rest") / BLOCK), F.ceil(F.col("size") / BLOCK)), percent), "other-links")
    return copies.union(near).union(far)
