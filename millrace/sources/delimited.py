"""Delimited text: declared, inferred, or described by an attribute file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type tokens of an attribute file.
ATTRIBUTE_TYPES = {
    "NUMERIC": T.DoubleType(),
    "real": T.DoubleType(),
    "string": T.StringType(),
    "STRING": T.StringType(),
}

_ATTRIBUTE_FILE = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("type", T.StringType())]
)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    sep: str = ",",
    header: bool = False,
    spread: int | None = None,
) -> DataFrame:
    """One file, several, a glob or a folder as one table with a declared schema.

    Compressed files are told by their extension. A gzip file is one task however
    large it is; ``spread`` deals its rows out to that many partitions after the scan.
    """
    df = spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)
    return df.repartition(spread) if spread else df


def read_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A file with a header line, the types guessed by a pass over the data."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def attribute_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema an attribute file of ``name,type`` lines describes."""
    rows = spark.read.schema(_ATTRIBUTE_FILE).csv(path).collect()  # one row a column
    unknown = sorted({str(r["type"]) for r in rows} - ATTRIBUTE_TYPES.keys())
    if unknown:
        raise ValueError(f"unknown attribute types in {path}: {', '.join(unknown)}")
    return T.StructType([T.StructField(r["name"], ATTRIBUTE_TYPES[r["type"]]) for r in rows])


def read_with_attributes(spark: SparkSession, attr_path: str, data_path: str) -> DataFrame:
    """A headerless file typed by its attribute file."""
    return read_delimited(spark, data_path, attribute_schema(spark, attr_path))


def load_many(
    spark: SparkSession,
    names: list[str],
    root: str,
    attributes: str = "attributes/{}.attributes.csv",
    features: str = "features/{}.csv",
) -> dict[str, DataFrame]:
    """A family of datasets below one folder, each with its attribute file."""
    return {
        name: read_with_attributes(
            spark, f"{root}/{attributes.format(name)}", f"{root}/{features.format(name)}"
        )
        for name in names
    }


def family_schemas(spark: SparkSession, names: list[str], root: str, attributes: str = "attributes/{}.attributes.csv") -> dict[str, T.StructType]:
    """The schemas of a family of datasets; all attribute files are read in one job.

    A line is a column, so what reaches the driver is as long as the datasets are wide. An attribute
    file may also be a folder of one part.
    """
    paths = {name: f"{root.rstrip('/')}/{attributes.format(name)}" for name in names}
    read = spark.read.text(list(paths.values()), wholetext=True)
    lines = F.filter(F.split("value", r"\r?\n"), lambda line: F.trim(line) != "")
    fields = F.transform(lines, lambda line: F.from_csv(line, F.lit("name string, type string")))
    found = read.select(F.col("_metadata.file_path").alias("file"), fields.alias("fields")).where(F.size("fields") > 0).collect()
    schemas = {}
    for name in names:
        tail = f"/{attributes.format(name)}"
        own = [r for r in found if r["file"].endswith(tail) or f"{tail}/" in r["file"]]
        if len(own) != 1:
            raise ValueError(f"{len(own)} attribute files for {name}")
        unknown = sorted({str(f["type"]).strip() for f in own[0]["fields"]} - ATTRIBUTE_TYPES.keys())
        if unknown:
            raise ValueError(f"unknown attribute types in {own[0]['file']}: {', '.join(unknown)}")
        schemas[name] = T.StructType([T.StructField(f["name"], ATTRIBUTE_TYPES[f["type"].strip()]) for f in own[0]["fields"]])
    return schemas


def load_family(
    spark: SparkSession,
    names: list[str],
    root: str,
    attributes: str = "attributes/{}.attributes.csv",
    features: str = "features/{}.csv",
    corrupt: str = "_corrupt",
) -> dict[str, DataFrame]:
    """A family of datasets below one folder, typed in one job, with their bad lines.

    A line whose values don't parse, or that has more or fewer of them than the dataset has columns, keeps
    what it has, and is itself in ``corrupt``; ``_file`` names the file of every line.
    """
    out = {}
    for name, schema in family_schemas(spark, names, root, attributes).items():
        wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        reader = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
        df = reader.csv(f"{root.rstrip('/')}/{features.format(name)}")
        out[name] = df.withColumn("_file", F.col("_metadata.file_name"))
    return out


def bad_lines(family: dict[str, DataFrame], corrupt: str = "_corrupt") -> DataFrame:
    """(dataset, file, n_lines, n_bad) of every file of a family."""
    parts = []
    for name, df in family.items():
        # A line is bad by any of its columns, so all are read: those with an odd hash and the others are the lines.
        odd = F.hash(*[F.col(f"`{c}`") for c in df.columns if c not in (corrupt, "_file")]) % 2 != 0
        rows = df.select(F.col("_file").alias("file"), F.col(corrupt).isNotNull().alias("bad"), odd.alias("odd"))
        n_lines = F.count_if("odd") + F.count_if(~F.col("odd"))
        counts = rows.groupBy("file").agg(n_lines.alias("n_lines"), F.count_if("bad").alias("n_bad"))
        parts.append(counts.select(F.lit(name).alias("dataset"), "file", "n_lines", "n_bad"))
    return reduce(DataFrame.unionByName, parts)


def attribute_types(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The distinct type tokens used in a set of attribute files."""
    tokens = spark.read.schema(_ATTRIBUTE_FILE).csv(path)
    return tokens.select(F.trim("type").alias("type")).distinct()
