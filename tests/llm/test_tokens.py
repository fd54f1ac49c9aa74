import zlib
import glob

import numpy as np
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.llm import tokens
from orderloom.session import scratch_path

from cases import ROWS, rows


def _plain():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.default_tokenizer())


def _expected(data):
    tk, start, out = _plain(), 0, []
    texts = sorted(((2**63 - 1 if d is None else d), d, t or "") for d, t in data)
    for _, d, t in texts:
        ids = tk.encode(t, add_special_tokens=False).ids + [2]
        out.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def test_round_trip_equals_plain_encoding(spark):
    got = tokens.round_trip(rows(spark, clash=("ids", "part", "first", "place", "tie"))).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == \
        sorted(x for x in _expected([(r[0], r[1]) for r in ROWS]) if x[0] is not None)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1]]
    keys = [2**63 - 1 if r.doc_id is None else r.doc_id for r in ordered]
    assert keys == sorted(keys)


def test_empty_table(spark):
    assert tokens.round_trip(rows(spark, [])).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=" \n\t\x1c\xa0\u2003aAéǅΣσ'sDd1.!́中<|endoftext|>", max_size=60))
def test_chunks_give_the_ids_of_the_whole_text(text):
    ends, ids = tokens._encoder(tokens.default_tokenizer()).batch(["before it", text, "", text])
    plain = [_plain_cached().encode(t, add_special_tokens=False).ids for t in ("before it", text, "", text)]
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == plain


_CACHE = []


def _plain_cached():
    if not _CACHE:
        _CACHE.append(_plain())
    return _CACHE[0]


def test_file_format(spark):
    path = scratch_path(spark, "test-tokens")
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("token output"), F.col("id").cast("string")).alias("text"))
    tokens.write_tokens(docs, path)
    files = glob.glob(path.replace("file:", "") + "/*.parquet")
    group = next(m.row_group(0) for m in (pq.ParquetFile(f).metadata for f in files) if m.num_row_groups)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    ids = columns["ids.list.element"]
    assert "RLE_DICTIONARY" in ids.encodings or "PLAIN_DICTIONARY" in ids.encodings
    assert ids.compression == "ZSTD" and ids.has_offset_index and columns["doc_id"].has_column_index
    # lengths alone do not read the ids
    plan = tokens.part_offsets(tokens.read_tokens(spark, path))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<part:int,n_tokens:bigint>" in plan
    # one document: a pushed filter on the sorted id
    one = tokens.read_tokens(spark, path).where("doc_id = 17")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)]" in one._jdf.queryExecution().toString()
    assert one.collect()[0].ids[-1] == 2


def test_special_tokens_in_other_case_are_plain_text():
    assert all(t.content.startswith(tokens.SPECIAL) for t in _plain_cached().get_added_tokens_decoder().values())
    texts = ["<|ENDOFTEXT|>", "A Text <|StartOfText|> and\nMORE", "<|endoftext|>", "a<|EndOfText|>. B", "PLAIN"]
    ends, ids = tokens._encoder(tokens.default_tokenizer()).batch(texts)
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [_plain_cached().encode(t, add_special_tokens=False).ids for t in texts]
