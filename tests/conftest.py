import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "6g")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def toy_train(spark):
    return spark.createDataFrame(
        [(0, "just plain boring", 1), (0, "entirely predictable and lacks energy", 2),
         (0, "no surprises and very few laughs", 3), (4, "very powerful", 4),
         (4, "the most fun film of the summer", 5)], "label int, text string, doc_id bigint")


@pytest.fixture(scope="session")
def toy_labels(spark):
    from tallystar.operators.labels import inline_labels
    return inline_labels(spark, [0, 4])


@pytest.fixture(scope="session")
def toy_test(spark):
    return spark.createDataFrame([(0, "predictable with no fun", 1)],
                                 "label int, text string, doc_id bigint")


def rows(df, *columns):
    """All rows as sorted tuples, of the named columns or all."""
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)
