import pytest
from pyspark.sql import SparkSession

from termloom.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = configure(SparkSession.builder.master("local[4]").appName("termloom-tests"))
    session = (
        builder.config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Five short documents; the last has no token.
GOLDEN_DOCS = [
    (1, "uno.txt", "Queso de cabra: un queso sabroso. El queso manchego también es queso excelente."),
    (2, "dos.txt", "La cabra come hierba; la cabra camina."),
    (3, "tres.txt", "Camión rojo, camión azul: el camión no camina 123."),
    (4, "cuatro.txt", "queso-cabra y vino. Vino tinto."),
    (5, "cinco.txt", "12345 ... de la que!"),
]
DOC_SCHEMA = "doc_id bigint, filename string, text string"


@pytest.fixture(scope="session")
def golden_docs(spark):
    return spark.createDataFrame(GOLDEN_DOCS, DOC_SCHEMA)


@pytest.fixture(scope="session")
def golden_index(golden_docs, tmp_path_factory):
    from termloom.sources.index_store import index_corpus

    return index_corpus(golden_docs, str(tmp_path_factory.mktemp("golden")))
