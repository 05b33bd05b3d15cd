from pyspark.sql import SparkSession


def local_session(cores: int = 8, partitions: int | None = None, **settings) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wordtide")
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
