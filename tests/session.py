import tempfile

from pyspark.sql import SparkSession


def get_spark(partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("panelflume-tests")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="panelflume-test-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
