"""Saved raw-event schema with additive evolution.

The schema lives as JSON text in the shared state folder and is read and
written through the Hadoop FileSystem API, so any cluster file system works.
Evolution is additive: top-level fields seen for the first time are appended;
a field keeps its first saved type forever, because Parquet
files with two types for one column cannot be read together.  Values
that do not fit the saved type stay in ``_rescued``, their lines in ``_corrupt_record``.

Inference reads each raw file once: a ledger beside the schema holds the files
that were inferred.  It takes any line: broken ones are passed over, of
repeated keys the last counts, of names that differ only in case one becomes
the column and the others stay in ``_rescued``.
"""

from __future__ import annotations

import contextlib
import json
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators.bronze import ADDED_COLUMNS, SDK_RENAMES

CORRUPT_COLUMN = "_corrupt_record"
# Free-form payload objects are stored as their JSON text: every key survives
# without schema changes (Parquet catalog tables cannot add nested fields), and
# the canonical layer parses the text once per row.
TEXT_FIELDS = ("properties",)
# Keys and codes of the canonical layer are text there; a first file that writes them as numbers must not fix another type.
KEY_FIELDS = (*SDK_RENAMES, *SDK_RENAMES.values(), "site_id", "user_id", "url", "page_url", "pageUrl", "referrer")
# Metadata mark of fields that come from the folder names, not from the lines.
IN_PATH = "in_path"
# Files that one inference job lists in its plan, and pieces after which the ledger is rewritten as one.
FILES_PER_JOB, LEDGER_PIECES = 10_000, 64


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def has_files(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.listFiles(p, True).hasNext()


def read_text(spark: SparkSession, file: str) -> str | None:
    fs, p = _fs(spark, file)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
    finally:
        stream.close()
    return "\n".join(lines)


def write_text(spark: SparkSession, file: str, text: str) -> None:
    fs, p = _fs(spark, file)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def load_schema(spark: SparkSession, path: str) -> T.StructType | None:
    text = read_text(spark, f"{path.rstrip('/')}/schema.json")
    return None if text is None else T.StructType.fromJson(json.loads(text))


def save_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    write_text(spark, f"{path.rstrip('/')}/schema.json", schema.json())


def is_in_path(field: T.StructField) -> bool:
    return bool((field.metadata or {}).get(IN_PATH))


def merge_schemas(saved: T.StructType | None, seen: T.StructType) -> T.StructType:
    """Saved fields first with their saved types, then new top-level fields.

    A saved struct is not widened: catalog tables cannot add nested fields, so
    the stream keeps new nested keys in ``_rescued`` instead.  So it does with a
    new name that differs from a saved one only in case, before or after the SDK renames.
    """
    out = {f.name: f for f in (saved.fields if saved else [])}
    paths = {f.name for f in seen.fields if is_in_path(f)}
    out = {n: T.StructField(n, f.dataType, f.nullable, {**(f.metadata or {}), IN_PATH: True}) if n in paths else f
           for n, f in out.items()}
    for f in seen.fields:
        if f.name not in out and not any(_collide(f.name, name) for name in out):
            out[f.name] = f
    return T.StructType(list(out.values()))


def _collide(one: str, other: str) -> bool:
    """Whether two names that differ would name one column; an SDK name and its canonical one may stand together."""
    if one.lower() == other.lower():
        return True
    spelled = {*SDK_RENAMES, *SDK_RENAMES.values()}
    canonical = lambda n: SDK_RENAMES.get(n, n).lower()
    return canonical(one) == canonical(other) and not (one in spelled and other in spelled)


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    if CORRUPT_COLUMN in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


@contextlib.contextmanager
def _any_keys(spark: SparkSession) -> Iterator[None]:
    """Within this, a JSON object may repeat a key; the last one counts."""
    conf = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "true")
    try:
        yield
    finally:
        spark.conf.set(conf, before)


def _plain_type(kind: T.DataType) -> T.DataType:
    """The column type for what a variant aggregate found: mixed, null and empty ones are text."""
    if isinstance(kind, T.StructType):
        fields: dict[str, T.StructField] = {}
        # Of names that differ only in case the one with more small letters comes first.
        for f in sorted(kind.fields, key=lambda f: f.name.swapcase()):
            fields.setdefault(f.name.lower(), T.StructField(f.name, _plain_type(f.dataType), True))
        return T.StructType(sorted(fields.values(), key=lambda f: f.name)) if fields else T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain_type(kind.elementType), True)
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, 0) if kind.scale == 0 else T.DoubleType()
    return kind if isinstance(kind, (T.LongType, T.DoubleType, T.BooleanType)) else T.StringType()


def _seen_type(text: str) -> T.DataType:
    """The type that ``schema_of_variant_agg`` printed; names within backquotes stay as they are."""
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text)
    return T.DataType.fromDDL(ddl)


def infer_schema(spark: SparkSession, path: str | list[str], *, base_path: str | None = None,
                 sampling_ratio: float = 1.0) -> T.StructType | None:
    """Schema of the JSON objects in raw files, by one mergeable aggregate over their lines; None without files.

    Times and keys are text (parsing happens downstream), so a malformed one never changes a column type. Fields
    that have the name of a column that ingestion adds are left out and stay in ``_rescued``.
    """
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    try:
        lines = reader.text(path)
    except Exception as exc:  # no files yet
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise
    in_path = [T.StructField(f.name, f.dataType, True, {IN_PATH: True}) for f in lines.schema.fields if f.name != "value"]
    objects = lines.where(F.ltrim("value").startswith("{"))
    if sampling_ratio < 1:
        objects = objects.sample(sampling_ratio)
    with _any_keys(spark):
        text = objects.agg(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]
    kind = _plain_type(_seen_type(text))
    taken = {f.name.lower() for f in in_path} | {CORRUPT_COLUMN, *ADDED_COLUMNS}
    fields = [T.StructField(f.name, T.StringType(), True) if f.name in TEXT_FIELDS or f.name in KEY_FIELDS else f
              for f in (kind.fields if isinstance(kind, T.StructType) else []) if f.name.lower() not in taken]
    return merge_schemas(None, T.StructType([*fields, *in_path]))


def _ledger(spark: SparkSession, store_path: str) -> str:
    return f"{store_path.rstrip('/')}/inferred"


def new_files(spark: SparkSession, store_path: str, raw_path: str) -> list[str]:
    """Raw files that no earlier inference read. The listing reads no file."""
    if not has_files(spark, raw_path):
        return []
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw_path).select("path"))
    if has_files(spark, _ledger(spark, store_path)):
        known = spark.read.schema("path string").option("recursiveFileLookup", "true").parquet(_ledger(spark, store_path))
        listed = listed.join(known, "path", "left_anti")
    return sorted(r["path"] for r in listed.collect())  # names only, of the new files


def _record(spark: SparkSession, store_path: str, files: list[str]) -> None:
    """Add files to the ledger; many small pieces are rewritten as one."""
    ledger = _ledger(spark, store_path)
    spark.createDataFrame([(f,) for f in files], "path string").coalesce(1).write.parquet(f"{ledger}/{uuid.uuid4().hex}")
    fs, p = _fs(spark, ledger)
    pieces = [str(x.getPath()) for x in fs.listStatus(p)]
    if len(pieces) > LEDGER_PIECES:
        whole = spark.read.schema("path string").parquet(*pieces).distinct()
        whole.write.parquet(f"{ledger}/{uuid.uuid4().hex}")
        for piece in pieces:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(piece), True)


def evolve(spark: SparkSession, store_path: str, raw_path: str, *, sampling_ratio: float = 1.0) -> T.StructType | None:
    """Saved schema widened by what the new raw files hold; saved back, then the files are entered in the ledger.

    File dates are not used: a file copied in late with an old date counts like any other. A run that ends between the two
    writes infers the same files again, with the same outcome.
    A field that first appears after this inference stays in the stream's
    ``_rescued`` column and becomes a column of its own at the next start.
    """
    saved = load_schema(spark, store_path)
    files = new_files(spark, store_path, raw_path)
    for at in range(0, len(files), FILES_PER_JOB):
        some = files[at:at + FILES_PER_JOB]
        escaped = [re.sub(r"([{}\[\]*?\\])", r"\\\1", f) for f in some]  # names, not patterns
        seen = infer_schema(spark, escaped, base_path=raw_path, sampling_ratio=sampling_ratio)
        if seen is not None:
            merged = merge_schemas(saved, seen)
            if saved is None or merged.json() != saved.json():
                save_schema(spark, store_path, merged)
            saved = merged
        _record(spark, store_path, some)
    return saved
