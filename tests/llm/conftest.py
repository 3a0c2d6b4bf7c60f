import pytest
from pyspark.sql import functions as F

from llm_cases import docs_frame, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    return docs_frame(spark, odd_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return docs_frame(spark, []).where(F.lit(False))


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, 0 if i % 3 == 0 else 1, 1 if i % 4 == 0 else 0) for i in range(1, 10)]
                                 + [(None, 1, 1), (1, None, None), (2, 1, 0)],
                                 "doc_id long, quality int, toxic int")
