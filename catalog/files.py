"""Raw files and geographic files that Spark derives from the provided tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.inputs import dirty, fresh, households, table, weather
from sievewatt.functions import geometry as G
from sievewatt.runtime import durable, spread
from sievewatt.sources import raw

# Users' blocks as households name them, events in one file of readings, and users in one file of daily sums.
BLOCKS = 16
EVENTS_PER_BLOCK = 1000
USERS_PER_BLOCK = 50
# Parts that one task turns into outlines.
PARTS_PER_TASK = 5_000
# Blocks that one task writes.
BLOCKS_PER_TASK = 32
# Events in one file of a stream, and the most files in one micro-batch: a micro-batch costs seconds whatever it holds.
STREAM_ROWS = 100_000
FILES_PER_TRIGGER = 12
# The same for files of readings, which are small.
BLOCKS_PER_TRIGGER = 1000


def name_blocks(spark: SparkSession, staged: str, folder: str) -> str:
    """Give the files Spark wrote under ``block=<n>`` the names a block reader looks for."""
    fs_classes = spark._jvm.org.apache.hadoop.fs
    fs = fs_classes.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_classes.Path(folder))
    paths = [status.getPath().toString() for status in fs.globStatus(fs_classes.Path(f"{staged}/block=*/part-*.csv"))]

    def name(path: str) -> None:
        number = path.rsplit("/", 2)[1].split("=")[1]
        fs.rename(fs_classes.Path(path), fs_classes.Path(f"{folder}/block_{number}.csv"))

    with ThreadPoolExecutor(8) as threads:
        list(threads.map(name, paths))
    return folder


def write_blocks(rows: DataFrame, folder_name: str) -> str:
    """One CSV file per block, as the meters deliver them. Blocks are ranges of a key, so that their number, and with
    it the number of tasks, follows the number of rows."""
    spark = rows.sparkSession
    staged, folder = fresh(spark, f"{folder_name}-staged"), fresh(spark, folder_name)
    low, high = rows.agg(F.min("block"), F.max("block")).first()
    parts = ((high or 0) - (low or 0)) // BLOCKS_PER_TASK + 1
    rows.repartitionByRange(parts, "block").write.partitionBy("block").option("header", True).csv(staged)
    return name_blocks(spark, staged, folder)


def readings_csv(spark: SparkSession, sf: str) -> str:
    return write_blocks(
        dirty(spark, sf).select(
            F.col("user_id").cast("string").alias("LCLid"),
            F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(".0000000")).alias("tstp"),
            F.concat(F.lit(" "), F.coalesce(F.col("value").cast("string"), F.lit("Null"))).alias("energy(kWh/hh)"),
            F.floor(F.col("event_id") / EVENTS_PER_BLOCK).alias("block"),
        ),
        "halfhourly",
    )


def daily_csv(spark: SparkSession, sf: str) -> str:
    v = F.col("value")
    daily = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.percentile(v, 0.5).alias("energy_median"),
        F.avg(v).alias("energy_mean"),
        F.max(v).alias("energy_max"),
        F.count(F.lit(1)).alias("energy_count"),
        # a day of one reading has no spread: the file holds an empty string
        F.coalesce(F.stddev_samp(v).cast("string"), F.lit("")).alias("energy_std"),
        F.sum(v).alias("energy_sum"),
        F.min(v).alias("energy_min"),
    )
    return write_blocks(
        daily.select(
            F.col("user_id").alias("LCLid"),
            "day",
            "energy_median",
            "energy_mean",
            "energy_max",
            "energy_count",
            "energy_std",
            "energy_sum",
            "energy_min",
            F.floor(F.col("user_id") / USERS_PER_BLOCK).alias("block"),
        ),
        "daily",
    )


def stream_files(rows: DataFrame, key: str, rows_per_file: int = STREAM_ROWS) -> tuple[str, int]:
    """A folder of Parquet files that come one after the other in order of ``key``, and how many of them a micro-batch
    should take. Each file is a range of the key of bounded size."""
    spark = rows.sparkSession
    folder, n = fresh(spark, "stream"), rows.count()
    parts = max(3, -(-n // rows_per_file))
    rows.repartitionByRange(parts, key).sortWithinPartitions(key).write.option("maxRecordsPerFile", rows_per_file).parquet(folder)
    fs_classes = spark._jvm.org.apache.hadoop.fs
    fs = fs_classes.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    # a file stream takes older files first
    paths = sorted(f.getPath().toString() for f in fs.globStatus(fs_classes.Path(f"{folder}/part-*")))
    for i, path in enumerate(paths):
        fs.setTimes(fs_classes.Path(path), 1_700_000_000_000 + 1000 * i, -1)
    return folder, per_trigger(parts, 3, FILES_PER_TRIGGER)


def per_trigger(n: int, batches: int, most: int) -> int:
    """Files in a micro-batch so that ``n`` files make at least ``batches`` of them, but no more than ``most`` files each."""
    return max(1, min(n // batches, most))


def blocks_per_trigger(spark: SparkSession, folder: str) -> int:
    """How many of a folder's blocks a micro-batch should take."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return max(8, per_trigger(len(fs.listStatus(path)), 8, BLOCKS_PER_TRIGGER))


def _csv(df: DataFrame, name: str) -> str:
    path = fresh(df.sparkSession, name)
    # Text categories keep the blanks around them, as in the files this stands for.
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def weather_hourly_csv(spark: SparkSession, sf: str) -> str:
    known = {
        "temperature": F.col("temperature_celsius"),
        "humidity": F.col("humidity_ratio"),
        "summary": F.col("weather_summary"),
    }
    columns = [*raw.WEATHER_HOURLY_NUMBERS, *raw.WEATHER_HOURLY_TEXTS]
    return _csv(
        weather(spark, sf).select(
            F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("time"),
            *[known.get(c, F.lit(None).cast("string")).alias(c) for c in columns],
        ),
        "weather-hourly",
    )


def weather_daily_csv(spark: SparkSession, sf: str) -> str:
    per_day = table(spark, sf, "events").groupBy(F.to_date("ts").alias("d")).agg(
        F.max("value").alias("temperatureMax"), F.min("value").alias("temperatureMin"), F.max("event_type").alias("summary")
    )
    time = F.date_format("d", "yyyy-MM-dd 00:00:00").alias("time")
    return _csv(per_day.select(time, "temperatureMax", "temperatureMin", "summary"), "weather-daily")


def households_csv(spark: SparkSession, sf: str) -> str:
    return _csv(
        households(spark, sf).select(
            F.col("user_id").alias("LCLid"),
            F.col("tariff_type").alias("stdorToU"),
            F.col("acorn_code").alias("Acorn"),
            F.col("acorn_group").alias("Acorn_grouped"),
            F.concat(F.lit("block_"), (F.col("user_id") % BLOCKS).cast("string")).alias("file"),
        ),
        "households",
    )


def holidays_csv(holidays: DataFrame) -> str:
    return _csv(holidays.select(F.col("holiday_date").alias("Bank holidays"), F.lit("Sunday").alias("Type")), "holidays")


def segments_csv(spark: SparkSession, sf: str) -> str:
    return _csv(
        table(spark, sf, "part").select(
            F.col("p_partkey").alias("part key"), F.col("p_brand").alias("brand name("), F.col("p_type").alias("brand name/")
        ),
        "segments",
    )


def areas_geojson(spark: SparkSession, sf: str, level: int = 3, collection: bool = False) -> str:
    """An L-shaped area with a square hole per nation, on a grid five wide; as features, or in a collection per region."""
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    x0 = (F.col("n_nationkey") % 5).cast("double")
    y0 = F.lit(50.0) + F.floor(F.col("n_nationkey") / 5)

    def ring(*corners: tuple[float, float]):
        return F.array(*[F.array(x0 + dx, y0 + dy) for dx, dy in corners])

    outer = ring((0, 0), (0.9, 0), (0.9, 0.5), (0.5, 0.5), (0.5, 0.9), (0, 0.9), (0, 0))
    hole = ring((0.1, 0.1), (0.3, 0.1), (0.3, 0.3), (0.1, 0.3), (0.1, 0.1))
    properties = {
        f"GID_{level}": F.concat(F.lit("A"), F.col("n_nationkey").cast("string")),
        "COUNTRY": F.col("r_name"),
        "NAME_1": F.col("r_name"),
        "NAME_2": F.concat(F.lit("county "), F.col("n_nationkey").cast("string")),
        "NAME_3": F.col("n_name"),
    }
    path = fresh(spark, "areas")
    features = nations.select(
        F.lit("Feature").alias("type"),
        F.struct(*[c.alias(k) for k, c in properties.items()]).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(outer, hole).alias("coordinates")).alias("geometry"),
    )
    if collection:
        whole = F.collect_list(F.struct("type", "properties", "geometry")).alias("features")
        features = features.groupBy(F.col("properties.COUNTRY").alias("name")).agg(F.lit("FeatureCollection").alias("type"), whole)
    features.write.json(path)
    return path


def parts(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and sizes of the parts, dealt over tasks: their outlines cost far more than their bytes tell. They are written, as
    Spark would else carry conditions on outlines back to the one task that reads the file."""
    return durable(spread(table(spark, sf, "part").select("p_partkey", "p_size"), PARTS_PER_TASK))


def building_corners(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as small rectangular buildings."""
    key = F.col("p_partkey")
    x = (key * 37 % 5000) / F.lit(1000.0) + 0.0005
    y = F.lit(50.0) + (key * 91 % 5000) / F.lit(1000.0) + 0.0005
    return parts(spark, sf).select(
        "p_partkey", "p_size", F.array(*[G.point(x + dx, y + dy) for dx, dy in ((0, 0), (0.0001, 0), (0.0001, 0.0002), (0, 0.0002))]).alias("corners")
    )


def buildings_xml(spark: SparkSession, sf: str) -> str:
    """OSM XML: four nodes and one closed way per part. Every 50th way repeats a tag with another value, of every
    70th a node is missing."""
    corners = building_corners(spark, sf)
    folder = fresh(spark, "osm")
    placed = corners.select("p_partkey", F.posexplode("corners").alias("i", "p"))
    placed.filter((F.col("p_partkey") % 70 != 0) | (F.col("i") != 2)).select(
        (F.col("p_partkey") * 10 + F.col("i")).alias("_id"), F.col("p.y").alias("_lat"), F.col("p.x").alias("_lon")
    ).write.format("xml").option("rootTag", "osm").option("rowTag", "node").save(f"{folder}/nodes")
    ref = lambda i: F.struct((F.col("p_partkey") * 10 + i).alias("_ref"))
    tag = lambda k, v: F.struct(F.lit(k).alias("_k"), F.lit(v).alias("_v"))
    corners.select(
        F.col("p_partkey").alias("_id"),
        F.array(*[ref(i) for i in (0, 1, 2, 3, 0)]).alias("nd"),
        F.concat(
            F.when(F.col("p_size") > 25, F.array(tag("landuse", "retail"), tag("source", "survey"))).otherwise(
                F.array(tag("building", "yes"), tag("source", "survey"))
            ),
            F.when(F.col("p_partkey") % 50 == 0, F.array(tag("source", "photo"), tag("building", "shed"))).otherwise(
                F.array().cast("array<struct<_k:string,_v:string>>")
            ),
        ).alias("tag"),
    ).write.format("xml").option("rootTag", "osm").option("rowTag", "way").save(f"{folder}/ways")
    return folder


def building_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The buildings as a table, without the detour over a file."""
    ring = F.concat("corners", F.slice("corners", 1, 1))
    return building_corners(spark, sf).select(
        F.concat(F.lit("way_"), F.col("p_partkey").cast("string")).alias("building_id"),
        F.array(ring).alias("rings"),
        G.ring_area_m2(ring).alias("area_m2"),
    )


# Where the sides of a zone may lie within its square of the grid: on, inside, outside and between the areas' outlines.
ZONE_SIDES = (0.0, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9, 1.0)


def zone_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A rectangle per part, which crosses, holds, fills, borders or misses areas and their holes."""
    key, sides, n = F.col("p_partkey"), F.array(*[F.lit(s) for s in ZONE_SIDES]), len(ZONE_SIDES)

    def side(k, base):
        low = k % (n - 1)
        high = low + 1 + F.floor(k / (n - 1)) % (n - 1 - low)
        return base + F.get(sides, low.cast("int")), base + F.get(sides, high.cast("int"))

    x1, x2 = side(key * 7, (key % 5).cast("double"))
    y1, y2 = side(key * 11 + F.floor(key / 25), F.lit(50.0) + F.floor(key / 5) % 5)
    ring = F.array(G.point(x1, y1), G.point(x2, y1), G.point(x2, y2), G.point(x1, y2), G.point(x1, y1))
    return parts(spark, sf).select(key.cast("string").alias("area_id"), F.array(ring).alias("rings"))
