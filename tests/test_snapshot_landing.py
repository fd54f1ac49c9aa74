"""How snapshot documents are put together and landed."""
import glob

from conftest import SF_SMALL
from orderloom.sources import testmap


def test_one_shuffle_by_document_and_compressed_files(spark, tmp_path):
    plan = testmap.snapshot_documents(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning(doc#" in line]
    assert len(shuffles) == 2                                          # the lines, and the parts they list
    path = testmap.land_snapshots(spark, SF_SMALL, str(tmp_path / "s"))
    assert glob.glob(f"{path}/*.json.gz")
