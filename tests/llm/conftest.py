import os

import pytest
from pyspark.sql import SparkSession

SF = os.environ.get("SUBTALLY_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    return SF


@pytest.fixture
def docs(spark: SparkSession):
    """Documents from (doc_id, text), with columns whose names clash with results."""

    def make(rows, parts: int = 3):
        full = [(d, t, "en", "src0", 1, "x", 9) for d, t in rows]
        kinds = ("doc_id long, text string, lang string, source string, n_chars long, "
                 "n_removed string, n_words long")
        return spark.createDataFrame(full, kinds).repartition(parts)

    return make
