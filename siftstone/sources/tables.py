"""Reading and writing the record tables: JSON lines, CSV imports and documents.

Every reader that needs the order of its input adds ``pos``, numbered without a
sort by partition counts.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from ..functions.text import padded_id, strip
from ..schemas import GOLD, RAW, schema
from .scratch import Scratch, delete


def with_pos(df: DataFrame, name: str = "pos", scratch: Scratch | None = None) -> DataFrame:
    """Adds the place of each row in the order of the files.

    Rows are written once with their tags, as a second run of the input may deal them
    otherwise; they are then counted by partition and numbered within it, and the counts,
    one a partition, give each partition its start.
    """
    spark = df.sparkSession
    scratch = scratch or Scratch(spark, "places")
    tagged = scratch.save(df.withColumn("__mono", F.monotonically_increasing_id()), f"tagged-{name}")
    part = F.shiftright("__mono", 33)
    counts = tagged.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()
    starts, total = [], 0
    for r in counts:
        starts.append((r["p"], total))
        total += r["n"]
    table = spark.createDataFrame(starts, "__p long, __start long")
    within = F.col("__mono").bitwiseAND(F.lit((1 << 33) - 1))
    joined = tagged.withColumn("__p", part).join(F.broadcast(table), "__p")
    return joined.withColumn(name, F.col("__start") + within).drop("__mono", "__p", "__start")


def _record(value: Column, ddl: str) -> Column:
    """A line as the record of a schema, with what breaks the schema as ``__bad``."""
    wanted = StructType([*schema(ddl).fields, StructField("__bad", StringType())])
    return F.from_json(value, wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})


def _broken(value: Column, record: Column) -> Column:
    """Whether a line holds no record; a list, a bare value or one with more after it is none."""
    # parsers stop at the end of a value, so the line is parsed with an end of its own
    ended = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), value, F.lit(',"end"]'))), "$[1]", "string") == "end"
    whole = strip(value).startswith("{") & strip(value).endswith("}") & F.coalesce(ended, F.lit(False))
    return ~whole | record["__bad"].isNotNull()


def read_jsonl(spark: SparkSession, path: str, ddl: str, ordered: bool = True) -> DataFrame:
    """Records of a JSON-lines file or folder; blank lines are skipped.

    Lines are parsed once into a table of the shared folder. If any holds no record of the
    schema, the first such line raises with its file and number, before a row is given out.
    """
    path = current(spark, path)
    lines = spark.read.text(path).filter(strip(F.col("value")) != "").withColumn("r", _record(F.col("value"), ddl))
    rows = with_pos(lines.select(F.col("r").dropFields("__bad").alias("r"), _broken(F.col("value"), F.col("r")).alias("bad")))
    if not rows.filter("bad").isEmpty():
        first = bad_lines(spark, path, ddl).orderBy("file", "line").first()
        raise ValueError(f"{first['file']}:{first['line']}: not a JSON record: {first['text']}")
    return rows.select("r.*", *["pos"] * ordered)


def bad_lines(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """(file, line, text): the lines of a JSON-lines file or folder that hold no record, from line 1.

    A large file is read in blocks by several tasks. A line's number is its place within
    its block and the lines of the file's earlier blocks; blank lines count. ``text`` is
    how the line starts.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    tagged = lines.withColumn("mono", F.monotonically_increasing_id()).withColumn("r", _record(F.col("value"), ddl))
    bad = (strip(F.col("value")) != "") & _broken(F.col("value"), F.col("r"))
    tagged = tagged.select("file", "block", "mono", F.when(bad, F.substring("value", 1, 200)).alias("text"))
    tagged = Scratch(spark, "lines").save(tagged, "tagged")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    blocks = tagged.groupBy("file", "block").agg(F.min("mono").alias("first"), F.count("*").alias("n"))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    line = F.col("before") + F.col("mono") - F.col("first") + 1
    return tagged.filter("text IS NOT NULL").join(blocks, ["file", "block"]).select("file", line.alias("line"), "text")


def write_jsonl(df: DataFrame, path: str, order: str | None = "pos") -> None:
    """Replaces a JSON-lines folder as a whole; nulls are written, other characters kept as they are.

    Rows go to a folder beside it, which takes its place once all are written, so a write
    that fails leaves the rows of before, and a table may be replaced by what is read from it.
    """
    if order and order in df.columns:
        df = df.orderBy(order).drop(order)
    staged = f"{path}.{uuid.uuid4().hex}.new"
    try:
        df.write.option("ignoreNullFields", "false").json(staged)
    except Exception:
        delete(df.sparkSession, staged)
        raise
    swap_in(df.sparkSession, staged, path)


def _at(spark: SparkSession, path: str):
    """A path of the JVM with its file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _rename(spark: SparkSession, source: str, target: str) -> None:
    (a, files), (b, _) = _at(spark, source), _at(spark, target)
    if not files.rename(a, b):
        raise OSError(f"{source} could not be renamed to {target}")


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished file or folder in the place of another one by renames.

    The one of before is kept as ``.old`` until the new one is there, and readers take it
    meanwhile (``current``), so a driver lost between the renames loses nothing. Renames are
    whole on a mount or HDFS; on a store that copies instead, this is no guard.
    """
    old = f"{path}.old"
    at, files = _at(spark, path)
    if files.exists(at):
        delete(spark, old)
        _rename(spark, path, old)
    _rename(spark, staged, path)
    delete(spark, old)


def current(spark: SparkSession, path: str) -> str:
    """The path, or the one of before where a swap did not end."""
    at, files = _at(spark, path)
    old, _ = _at(spark, f"{path}.old")
    return f"{path}.old" if not files.exists(at) and files.exists(old) else path


def write_document(spark: SparkSession, value, path: str) -> None:
    """One JSON document, or text, at any path that Spark reaches, replaced as a whole."""
    text = value if isinstance(value, str) else json.dumps(value, indent=2, ensure_ascii=False)
    staged = f"{path}.{uuid.uuid4().hex}.new"
    at, files = _at(spark, staged)
    out = files.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    swap_in(spark, staged, path)


def read_document(spark: SparkSession, path: str):
    """A JSON document, or None where there is none."""
    if not exists(spark, path):
        return None
    return json.loads(spark.read.text(current(spark, path), wholetext=True).first()["value"])


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _at(spark, current(spark, path))
    return files.exists(at)


def require(spark: SparkSession, path: str, stage: str) -> str:
    """The path, or an error that names the stage to run first."""
    if not exists(spark, path):
        raise FileNotFoundError(f"{path} is missing: run the {stage} stage first")
    return path


def copy_paths(spark: SparkSession, pairs: list[tuple[str, str]]) -> list[str]:
    """Copy each (source, target) that exists; returns the targets written."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    done = []
    for source, target in pairs:
        if exists(spark, source):
            a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (current(spark, source), target))
            jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, True, conf)
            done.append(target)
    return done


def checked_text(text: Column, row: Column) -> Column:
    """Stripped text; a blank one raises and names its row."""
    blank = F.coalesce(strip(text), F.lit("")) == ""
    return F.when(blank, F.raise_error(F.concat(F.lit("no text in row "), row.cast("string")))).otherwise(strip(text))


def imported(rows: DataFrame) -> DataFrame:
    """Records from rows (pos, text, id): ids fall back to the place, source is imported."""
    own = F.col("id").cast("string") if "id" in rows.columns else F.lit(None).cast("string")
    ident = F.when(F.coalesce(own, F.lit("")) == "", padded_id("imp", F.col("pos"))).otherwise(own)
    return rows.select(
        "pos",
        ident.alias("id"),
        checked_text(F.col("text"), F.col("pos") + 1).alias("text"),
        F.lit("imported").alias("source"),
        F.lit(None).cast("map<string,string>").alias("seed"),
        F.lit(None).cast("string").alias("generator_model"),
    )


def import_records(spark: SparkSession, path: str) -> DataFrame:
    """Texts to triage from a .csv with a header, or from .jsonl or .ndjson, by suffix."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        rows = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    elif suffix in ("jsonl", "ndjson"):
        return imported(read_jsonl(spark, path, "id string, text string"))
    else:
        raise ValueError(f"cannot import .{suffix}: use .csv, .jsonl or .ndjson")
    if "text" not in rows.columns:
        raise ValueError("the import needs a text column")
    return imported(with_pos(rows))


def load_gold(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Gold rows in file order, the first ``limit`` of them."""
    rows = read_jsonl(spark, path, GOLD)
    return rows if limit is None else rows.orderBy("pos").limit(limit)


def append_records(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing rows and then the new ones; an id that exists already raises."""
    clash = new.join(existing.select("id"), "id", "left_semi").limit(1).collect()
    if clash:
        raise ValueError(f"id {clash[0]['id']} exists already: choose another prefix")
    start = existing.agg(F.coalesce(F.max("pos") + 1, F.lit(0)).alias("n")).first()["n"]
    return existing.unionByName(new.withColumn("pos", F.col("pos") + start))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, RAW)
