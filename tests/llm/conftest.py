import pytest

from feedward.llm.common import ensure_checkpoint_dir


@pytest.fixture(scope="session", autouse=True)
def checkpoints(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    ensure_checkpoint_dir(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) pairs."""

    def build(*pairs):
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)

    return build
