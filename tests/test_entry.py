"""The registry without the optional subpackage, or without what that imports."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {absent!r} or name.startswith({absent!r} + "."):
            raise ModuleNotFoundError(name, name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
names = e.queries()
assert len(names) > 80 and "pipeline" not in names and not [n for n in names if n.startswith("op1_")]
assert set(e.oracle_sql()) <= set(names)
"""


@pytest.mark.parametrize("absent", ["vaultrail.llm", "corpus_pipeline", "public_tokenizers"])
def test_the_other_queries_register(absent):
    subprocess.run([sys.executable, "-c", CODE.format(absent=absent)], cwd=ROOT, check=True, timeout=120)


def test_python_batches_are_bounded(spark):
    """Neither many rows nor long ones reach a Python worker in one batch."""
    from pyspark.sql import functions as F

    from vaultrail.session import configure

    configure(spark)

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})

    largest = lambda df: df.coalesce(1).mapInArrow(sizes, "n long, size long").agg(F.max("n"), F.max("size")).first()
    assert largest(spark.range(20_000))[0] <= 500
    assert largest(spark.range(400).select(F.repeat(F.lit("x"), F.lit(100_000)).alias("t")))[1] <= 5_000_000
