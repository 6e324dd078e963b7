"""State kept as one JSON object by platform: tolerant reading, upgrade of an older form, whole replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LABEL = "struct<empty_streak:int,backoff_until:double,visits:int,last_visit:double,last_video_at:double>"
_MAP = "map<string,string>"


def platform_states(raw: Column) -> Column:
    """Array of platform, current (label) and labels (map) of a state text; empty where it is no JSON object. A platform
    whose value is a string is of the older form: the current label alone."""
    whole = F.from_json(raw, _MAP)
    old = lambda v: ~F.startswith(F.trim(v), F.lit("{"))
    labels = lambda v: F.coalesce(F.from_json(F.get_json_object(v, "$.labels"), f"map<string,{_LABEL}>"), F.create_map().cast(f"map<string,{_LABEL}>"))
    entry = lambda e: F.struct(
        e["key"].alias("platform"), F.when(old(e["value"]), e["value"]).otherwise(F.get_json_object(e["value"], "$.current")).alias("current"), labels(e["value"]).alias("labels"))
    return F.transform(F.map_entries(F.coalesce(whole, F.create_map().cast(_MAP))), entry)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """platform, current, labels of a state file; no rows if it is missing or broken."""
    try:
        text = spark.read.text(path, wholetext=True)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "raw string").select(F.explode(platform_states(F.col("raw"))).alias("s")).select("s.*")
    return text.select(F.explode(platform_states(F.col("value"))).alias("s")).select("s.*")


def labels_of(states: DataFrame) -> DataFrame:
    """platform, label and the columns of its state; states without a usable label name are left out."""
    return states.select("platform", F.explode("labels").alias("label", "st")).filter(F.length("label") > 0).select("platform", "label", "st.*")


def hours_left(states: DataFrame, now: float) -> DataFrame:
    """platform, label, hours of labels that are still backed off."""
    left = (F.coalesce("backoff_until", F.lit(0.0)) - now) / 3600
    return labels_of(states).filter(left > 0).select("platform", "label", F.bround(left, 1).alias("hours"))


def save_state(states: DataFrame, path: str) -> None:
    """One JSON object in the place of the file, by one rename over it once it is whole: there is always an old or a new state.
    States are a row for each platform, a few."""
    spark = states.sparkSession
    entry = F.struct("platform", F.struct("current", "labels").alias("value"))
    whole = states.coalesce(1).agg(F.map_from_entries(F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["platform"] < b["platform"], -1).otherwise(1))).alias("m"))
    whole.select(F.to_json("m").alias("value")).write.mode("overwrite").text(f"{path}.tmp")
    hadoop = spark._jvm.org.apache.hadoop.fs
    tmp, target = hadoop.Path(f"{path}.tmp"), hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    (part,) = [f.getPath() for f in fs.listStatus(tmp) if f.getPath().getName().startswith("part-")]
    kind = getattr(hadoop, "Options$Rename")
    over = spark._sc._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(part, target, over)  # raises if it can't
    if not fs.delete(tmp, True):
        raise OSError(f"cannot delete {tmp}")
