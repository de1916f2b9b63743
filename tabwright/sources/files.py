"""Loading surveys and points of interest, and writing results."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions import numbers as N
from tabwright.functions import text as X
from tabwright.operators.cleaning import drop_unnamed, unpivot


@dataclass
class SurveyOptions:
    """Which columns of a survey table play which part; the steps run in the order of the fields."""

    drop_unnamed: bool = True
    us_numbers: list[str] = field(default_factory=list)
    line_ids: list[str] = field(default_factory=list)
    timestamps: list[str] = field(default_factory=list)
    georeferenced: list[str] = field(default_factory=list)
    abscissas: list[str] = field(default_factory=list)
    standardised: list[str] = field(default_factory=list)
    to_float: list[str] = field(default_factory=list)
    to_text: list[str] = field(default_factory=list)
    unpivot: dict | None = None
    standard_names: bool = True


def transform_survey(df: DataFrame, o: SurveyOptions) -> DataFrame:
    """All conversions as one projection over another, which the optimizer merges."""
    if o.drop_unnamed:
        df = drop_unnamed(df)
    for cols, f in ((o.us_numbers, N.us_number), (o.line_ids, X.line_id), (o.timestamps, N.date_text)):
        df = X.apply_columns(df, cols, f)
    for c in o.georeferenced:
        df = X.apply_columns(df, [c], lambda x, c=c: N.decimal_degrees(x, "latitud" if "lat" in c.lower() else "longitud"))
    for cols, f in ((o.abscissas, N.abscissa), (o.standardised, X.standardise), (o.to_float, lambda x: x.cast("double")), (o.to_text, lambda x: F.coalesce(x.cast("string"), F.lit("nan")))):
        df = X.apply_columns(df, cols, f)
    if o.unpivot:
        df = unpivot(df, o.unpivot["agg_cols"], o.unpivot["col_name"], o.unpivot["value_name"])
    return X.standardise_names(df) if o.standard_names else df


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Paths directly below a folder of any file system that Spark knows."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(s.getPath().toString() for s in found if s.isFile())


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_text_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Every tab-separated file with .txt in its name, put together by column names; columns that a file lacks are null.

    Files of one header are one scan, so a folder of thousands is a few scans."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in file_names(spark, folder):
        if ".txt" in path.rpartition("/")[2]:
            by_header.setdefault(tuple(spark.read.csv(path, sep="\t", header=True).columns), []).append(path)
    if not by_header:
        raise FileNotFoundError(f"no .txt file in {folder}")
    parts = [spark.read.csv(paths, sep="\t", header=True, inferSchema=True) for paths in by_header.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def load_survey(spark: SparkSession, path: str, options: SurveyOptions, compile_from_txt: bool = False) -> DataFrame:
    """A survey from a folder of text tables, a CSV or a Parquet file."""
    if compile_from_txt:
        df = read_text_tables(spark, path)
    elif path.endswith(".csv"):
        df = spark.read.csv(path, header=True, inferSchema=True)
    else:
        df = spark.read.parquet(path)
    return transform_survey(df, options)


#: Boxes that go to the scan as filters of their own; of more, their common bounds do.
FILTERED_BOXES = 64


def _z_order(lon: Column, lat: Column) -> Column:
    """A point's place on a curve that keeps neighbours together: the bits of both coordinates in turn, 16 of each."""

    def spread(c: Column, low: float, width: float) -> Column:
        x = F.least(F.greatest(F.floor((c.cast("double") - low) / width * 65_536), F.lit(0)), F.lit(65_535)).cast("bigint")
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
        return x

    return spread(lon, -180.0, 360.0).bitwiseOR(F.shiftleft(spread(lat, -90.0, 180.0), 1))


def save_pois(df: DataFrame, path: str, mode: str = "error", group_bytes: int = 8 << 20) -> None:
    """Points (lon, lat, tags) as Parquet files along a Z-curve, so that the bounds which each row group states are those of a small area."""
    ordered = df.withColumn("_z", _z_order(F.col("lon"), F.col("lat"))).repartitionByRange("_z").sortWithinPartitions("_z").drop("_z")
    ordered.write.mode(mode).option("parquet.block.size", group_bytes).parquet(path)


def load_pois(spark: SparkSession, path: str, boxes: dict[str, tuple[float, float, float, float]], tags: list[str] | None = None) -> DataFrame:
    """Points (lon, lat, tags) within the boxes of cities; a point of overlapping boxes comes once for each.

    One scan: the boxes reach it as filters, by which row groups are left out, and a point is exploded to the cities whose boxes it lies in."""
    df = spark.read.parquet(path)
    if tags:
        df = df.filter(reduce(lambda a, b: a | b, [F.col(t).isNotNull() for t in tags]))
    inside = lambda b: F.col("lon").between(b[0], b[2]) & F.col("lat").between(b[1], b[3])
    all_boxes = list(boxes.values())
    bounds = [tuple(f(b[i] for b in all_boxes) for i, f in enumerate((min, min, max, max)))] if all_boxes else []
    near = reduce(lambda a, b: a | b, [inside(b) for b in (all_boxes if len(all_boxes) <= FILTERED_BOXES else bounds)], F.lit(False))
    cities = F.filter(F.array(*[F.when(inside(b), city) for city, b in boxes.items()]).cast("array<string>"), lambda c: c.isNotNull())
    return df.filter(near).withColumn("city", F.explode(cities))


def save(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def save_geojson(df: DataFrame, path: str, lon: str = "lon", lat: str = "lat", mode: str = "error") -> None:
    """A GeoJSON feature a line."""
    props = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in (lon, lat)])
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), props.alias("properties"))
    df.select(F.to_json(feature).alias("value")).write.mode(mode).text(path)


def refresh(spark: SparkSession, path: str) -> None:
    spark.catalog.refreshByPath(path)
