from pyspark.sql import SparkSession

from tidelake.session import build_session


def local_session() -> SparkSession:
    spark = build_session("tidelake-tests", "local[8]", {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark
