"""JSON documents → rows.

Input is any DataFrame with a string column of JSON documents (S9), or files
read by ``read_json_files`` (S6–S8). Each document becomes rows by shape:

* a list → one row per member; object members give their fields, other
  members a single column ``value`` (R2);
* an object without list fields → one row; with one list field → one row per
  element, other fields repeated, an empty list giving no row (R3); with
  several list fields → positional zip, unequal lengths being an error (R4);
* a scalar → one row in column ``value`` (R5).

Nested objects are then flattened into dotted column names (R6; lists stop
the walk), the optional type schema is checked (Q3/Q4), and duplicate rows
are removed (A8).

Everything runs on executors as native expressions over the VARIANT type.
The only driver round trip is one aggregate, ``schema_of_variant_agg``, whose
result is a type string whose size depends on the distinct keys, not on the
number of documents. ``explode_lists`` picks which objects get the list rule:
``"document"`` (top-level objects only) or ``"record"`` (members of list
documents too).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..errors import CheckFailed, NotFound
from ..functions.text import PY_WHITESPACE
from ..operators.quality import as_spark_type
from ..operators.reshape import flatten as flatten_structs
from ..operators.reshape import strict_length
from ..operators.tail import require_columns
from ..session import staged
from .json_ranges import array_documents


def variant_type_to_ddl(schema: str) -> str:
    """Turn a ``schema_of_variant`` string into Spark DDL (OBJECT→STRUCT, VOID→STRING, fractions→DOUBLE)."""
    out, i, quoted = [], 0, False
    while i < len(schema):
        ch = schema[i]
        if ch == "`":
            if quoted and schema.startswith("``", i):
                out.append("``")
                i += 2
                continue
            quoted = not quoted
        elif not quoted:
            if schema.startswith("OBJECT<", i):
                out.append("STRUCT<")
                i += 7
                continue
            if schema.startswith("DECIMAL(", i):
                # a fraction is a double, whatever digits the documents happen to have
                end = schema.index(")", i)
                whole = schema[i:end].split(",")[1].strip() == "0"
                out.append(schema[i:end + 1] if whole else "DOUBLE")
                i = end + 1
                continue
            if schema.startswith("VOID", i) and not (i and (schema[i - 1].isalnum() or schema[i - 1] == "_")):
                out.append("STRING")
                i += 4
                continue
        out.append(ch)
        i += 1
    return "".join(out)


def _has_variant(dt: T.DataType) -> bool:
    if isinstance(dt, T.VariantType):
        return True
    if isinstance(dt, T.ArrayType):
        return _has_variant(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(_has_variant(f.dataType) for f in dt.fields)
    if isinstance(dt, T.MapType):
        return _has_variant(dt.valueType)
    return False


def _plain(df: DataFrame) -> DataFrame:
    """Replace VARIANT leaves (fields whose type differs between documents) by
    text so rows can be compared and grouped."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.VariantType):
            c = c.cast("string").alias(f.name)
        elif _has_variant(f.dataType):
            c = F.to_json(c).alias(f.name)
        cols.append(c)
    return df.select(*cols)


@dataclass(frozen=True)
class JsonShape:
    """What the reshaping needs to know about a set of documents.

    ``object_type``: Spark DDL of the object rows (``STRUCT<…>``), or None when
    there are none; ``value_type``: DDL of scalar members (column ``value``), or
    None; ``member_objects``: whether list documents contain objects (with the
    ``"document"`` rule their list fields then stay whole, so list columns are
    text). Infer it once with ``infer_json_shape`` (one pass), store it, and pass
    it to ``json_rows`` to skip that pass and give every batch the same schema. Items that do not fit a
    given shape are an error there; ``shape_misfits`` returns them.
    """
    object_type: str | None
    value_type: str | None
    member_objects: bool


def _document_items(df: DataFrame, col: str, keep=()) -> DataFrame:
    """Documents → one row per item: (v VARIANT, top BOOLEAN, _obj BOOLEAN) and the columns ``keep``."""
    # Blank text and JSON null are no document. Both are handled inside the
    # expressions (an empty member list) rather than by filters: a filter here
    # would be pushed below the input's exchange and parse every document twice.
    text = F.col(col)
    # The first non-blank character of a valid document tells its kind, so the
    # top level needs no walk over the parsed value.
    first = F.substring(F.btrim(text, F.lit(PY_WHITESPACE)), 1, 1)
    v = df.select(*keep, F.parse_json(F.when(_non_blank(text), text)).alias("_v"), first.alias("_first"))
    v_ = F.col("_v")
    no_doc = v_.isNull() | F.is_variant_null(v_)
    members = F.transform(v_.cast("array<variant>"), lambda e: F.struct(
        e.alias("v"), F.lit(False).alias("top"),
        F.schema_of_variant(e).startswith("OBJECT").alias("_obj")))
    single = F.array(F.struct(v_.alias("v"), F.lit(True).alias("top"),
                              (F.col("_first") == "{").alias("_obj")))
    items = (F.when(no_doc, F.filter(single, lambda x: F.lit(False)))
             .when(F.col("_first") == "[", members).otherwise(single))
    # *_outer generators + a filter after them: Spark infers no size() > 0
    # predicate for outer generators, so the item expression is built once.
    rows = v.select(*keep, F.inline_outer(items))
    return rows.where(F.col("v").isNotNull() & ~F.is_variant_null("v"))


def _by_kind(rows: DataFrame) -> DataFrame:
    """Items with objects in ``_o`` and other values in ``_p``."""
    return rows.withColumns({"_o": F.when(F.col("_obj"), F.col("v")), "_p": F.when(~F.col("_obj"), F.col("v"))})


def _shape_of(rows: DataFrame) -> JsonShape:
    agg = rows.agg(
        F.schema_of_variant_agg(F.when(F.col("_obj"), F.col("v"))).alias("obj"),
        F.schema_of_variant_agg(F.when(~F.col("_obj"), F.col("v"))).alias("val"),
        F.count_if(F.col("_obj")).alias("n_obj"),
        F.count_if(~F.col("_obj")).alias("n_val"),
        F.count_if(F.col("_obj") & ~F.col("top")).alias("n_member_obj")).first()
    return JsonShape(variant_type_to_ddl(agg["obj"]) if agg["n_obj"] else None,
                     variant_type_to_ddl(agg["val"]) if agg["n_val"] else None,
                     bool(agg["n_member_obj"]))


def infer_json_shape(df: DataFrame, col: str = "doc") -> JsonShape:
    """One aggregate pass (``schema_of_variant_agg``, partial per task); only a
    type string whose size depends on the distinct keys reaches the driver."""
    return _shape_of(_document_items(df, col))


def json_rows(df: DataFrame, col: str = "doc", *, flatten: bool = True,
              deduplicate: bool = True, schema: dict | None = None,
              explode_lists: str = "document", shape: JsonShape | None = None, keep=()) -> DataFrame:
    """The rows of the documents in ``col``; columns ``keep`` of ``df`` come with every row (and count when
    rows are deduplicated)."""
    if explode_lists not in ("document", "record"):
        raise ValueError("explode_lists must be 'document' or 'record'")
    spark = df.sparkSession
    items = rows = _document_items(df, col, keep)
    if shape is None or schema:
        # parsed once: the shape, the type check and the rows are all read from the staged values, objects and others
        # apart, as a scan casts every value of a column before any condition on it
        parted = staged(_by_kind(rows).drop("v"), "json-items")
        items = rows = parted.withColumn("v", F.coalesce("_o", "_p"))
    if shape is not None:
        # a given shape is a contract: an item that does not fit it stops the job
        misfit = _misfit(rows, shape)
        rows = rows.where(F.when(misfit.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(
            F.lit("an item does not have the declared shape: "), misfit)).cast("boolean")))
    shape = shape if shape is not None else _shape_of(rows)
    rows = rows if "_o" in rows.columns else _by_kind(rows)
    obj_ddl, val_ddl = shape.object_type, shape.value_type
    if obj_ddl is None and val_ddl is None:
        return spark.createDataFrame([], T.StructType([]))

    out_cols: list[Column] = [F.col(c) for c in keep]
    obj_type = struct_expr = None
    if obj_ddl:
        struct_expr = F.col("_o").cast(obj_ddl)
        obj_type = rows.select(struct_expr.alias("_s")).schema["_s"].dataType  # analysis only
    names = [f.name for f in obj_type.fields] if obj_type else []

    item_cols = [*map(F.col, keep), F.col("_obj"), F.col("top")]
    if obj_type:
        item_cols.append(struct_expr.alias("_s"))
    if val_ddl:
        item_cols.append(F.col("_p").cast(val_ddl).alias("_val"))
    rowwise = rows.select(*item_cols)

    # list rule (R3/R4) on objects it applies to
    list_fields = [f.name for f in obj_type.fields if isinstance(f.dataType, T.ArrayType)] if obj_type else []
    if list_fields:
        applies = F.col("_obj") & (F.col("top") | F.lit(explode_lists == "record"))
        arrays = [F.when(applies, F.col("_s").getField(n)) for n in list_fields]
        n = strict_length(arrays, list_fields)
        idx = (F.when(n.isNull(), F.array(F.lit(-1)))
               .when(n == 0, F.array().cast("array<int>"))
               .otherwise(F.sequence(F.lit(0), n - 1)))
        # list fields are lifted to top-level columns before the generator, so
        # nested-field pruning never has to look through it
        lifted = [F.col("_s").getField(n).alias(f"_list{i}") for i, n in enumerate(list_fields)]
        rowwise = rowwise.select("*", *lifted, idx.alias("_idx"))
        rowwise = rowwise.select(*[c for c in rowwise.columns if c != "_idx"],
                               F.explode_outer("_idx").alias("_pos"))
        rowwise = rowwise.where(F.col("_pos").isNotNull())
    # Objects the list rule skips keep whole lists; when such objects exist the
    # field holds elements in some rows and lists in others, so it becomes text.
    mixed = explode_lists == "document" and shape.member_objects
    for name in names:
        field = F.col("_s").getField(name)
        if name in list_fields:
            field = F.col(f"_list{list_fields.index(name)}")
            elem = F.get(field, F.col("_pos"))
            if mixed:
                etype = obj_type[name].dataType.elementType
                as_text = (elem.cast("string") if isinstance(etype, T.AtomicType)
                           else F.to_json(elem))
                field = F.when(F.col("_pos") >= 0, as_text).otherwise(F.to_json(field))
            else:
                field = F.when(F.col("_pos") >= 0, elem)
        out_cols.append(field.alias(name))
    if val_ddl:
        if "value" in names:
            idx_v = len(keep) + names.index("value")
            out_cols[idx_v] = F.coalesce(out_cols[idx_v].cast("string"),
                                         F.col("_val").cast("string")).alias("value")
        else:
            out_cols.append(F.col("_val").alias("value"))
    result = rowwise.select(*out_cols)
    if flatten:
        result = flatten_structs(result)
    result = _plain(result)
    if schema:
        require_columns(result, list(schema))
        found = _item_mismatches(items, schema, explode_lists).where("mismatches > 0")
        for r in found.orderBy("position").limit(1).collect():
            raise CheckFailed("type", r["column_name"], declared=schema[r["column_name"]], rows=r["mismatches"])
    if deduplicate:
        result = result.dropDuplicates()
    return result


def _path(name: str) -> str:
    """A variant path of a (dotted) column name, as an SQL literal."""
    parts = "".join('["' + x.replace("\\", "\\\\").replace("'", "\\'") + '"]' for x in name.split("."))
    return f"'${parts}'"


def _structs(dtype: T.StructType, prefix: str = "") -> list[tuple[str, list[str]]]:
    """(dotted path, field names) of a struct and the structs inside it."""
    out = [(prefix, dtype.names)]
    for f in dtype.fields:
        if isinstance(f.dataType, T.StructType):
            out += _structs(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)
    return out


def _prefixed(names: Column, prefix: str) -> Column:
    return F.transform(names, lambda k: F.concat(F.lit(prefix), k))


def _misfit(rows: DataFrame, shape: JsonShape) -> Column:
    """Why an item does not fit a shape: its kind, or fields that are not declared; null if it fits."""
    obj = F.lit("object") if shape.object_type is None else F.lit(None).cast("string")
    if shape.object_type:
        dtype = rows.select(F.expr(f"cast(v as {shape.object_type})").alias("s")).schema["s"].dataType
        extra = []
        for path, names in _structs(dtype):
            v = F.expr(f"try_variant_get(v, {_path(path)}, 'variant')") if path else F.col("v")
            keys = F.map_keys(v.try_cast("map<string, variant>"))
            unknown = F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*map(F.lit, names)))
            extra.append(_prefixed(unknown, f"{path}." if path else ""))
        found = F.array_sort(F.concat(*extra))
        obj = F.when(F.size(found) > 0, F.concat(F.lit("fields "), F.array_join(found, ",")))
    value = F.lit("value") if shape.value_type is None else F.lit(None).cast("string")
    return F.when(F.col("_obj"), obj).otherwise(value)


def shape_misfits(df: DataFrame, shape: JsonShape, col: str = "doc") -> DataFrame:
    """Items that ``json_rows`` would refuse under ``shape``: (reason, item).

    ``reason`` is ``value`` or ``object`` for an undeclared kind, else ``fields`` and the undeclared names.
    """
    rows = _document_items(df, col)
    return rows.select(_misfit(rows, shape).alias("reason"), F.to_json("v").alias("item")).where("reason IS NOT NULL")


def _conforms(kind: Column, expected) -> Column:
    """Whether a value of a variant's type conforms: booleans are integers too, nulls always conform."""
    whole = kind.startswith("DECIMAL") & kind.endswith(",0)")  # an integer beyond 64 bits
    ok = {T.LongType: kind.isin("BIGINT", "BOOLEAN") | whole, T.StringType: kind == "STRING",
          T.DoubleType: kind.isin("DOUBLE", "FLOAT") | (kind.startswith("DECIMAL") & ~whole),
          T.BooleanType: kind == "BOOLEAN"}
    same = {T.IntegerType: T.LongType, T.ShortType: T.LongType, T.ByteType: T.LongType, T.FloatType: T.DoubleType}
    dtype = type(as_spark_type(expected))
    return (kind == "VOID") | ok[same.get(dtype, dtype)]


def _misfit_members(members: Column, expected) -> Column:
    return F.size(F.filter(members, lambda e: ~_conforms(F.schema_of_variant(e), expected)))


def _item_mismatches(rows: DataFrame, expected: dict, explode_lists: str) -> DataFrame:
    """(column_name, position, mismatches) of the items' values as parsed, before anything is made text."""
    exploded = F.col("_obj") & (F.col("top") | F.lit(explode_lists == "record"))
    aggs, names = [], [c for c, t in expected.items() if t is not None]
    if not names:
        return rows.sparkSession.createDataFrame([], "column_name string, position int, mismatches bigint")
    for i, c in enumerate(names):
        field = F.expr(f"try_variant_get(v, {_path(c)}, 'variant')")
        if c == "value":
            field = F.when(F.col("_obj"), field).otherwise(F.col("v"))
        kind = F.schema_of_variant(field)
        is_list = exploded & kind.startswith("ARRAY")
        members = F.when(is_list, field).cast("array<variant>")
        of_list = _misfit_members(members, expected[c])
        bad = (F.when(field.isNull(), F.lit(0)).when(is_list, of_list)
               .otherwise((~_conforms(kind, expected[c])).cast("int")))
        aggs.append(F.coalesce(F.sum(bad), F.lit(0)).cast("long").alias(f"m{i}"))
    stacked = [F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"), F.col(f"m{i}").alias("mismatches"))
               for i, c in enumerate(names)]
    return rows.agg(*aggs).select(F.inline(F.array(*stacked)))


def json_type_mismatches(df: DataFrame, expected: dict, col: str = "doc",
                         explode_lists: str = "document") -> DataFrame:
    """Q4/U4: per declared column, values of the documents of another type.

    The values' own JSON types count: the text ``"12"`` is no integer, ``2.5`` is a float and no integer.
    Lists that the list rule explodes are checked element by element.
    """
    return _item_mismatches(_document_items(df, col), expected, explode_lists)


def json_object_rows(spark: SparkSession, obj, **kwargs) -> DataFrame:
    """S9 for an in-memory object: a dict, list or scalar becomes one document
    and follows the same rules as ``json_rows`` (an empty list gives no rows)."""
    import json
    doc = spark.createDataFrame([(json.dumps(obj),)], "doc string")
    return json_rows(doc, "doc", **kwargs)


def _non_blank(c: Column) -> Column:
    return F.btrim(c, F.lit(PY_WHITESPACE)) != ""


def documents_from_text(raw: DataFrame, text_col: str = "value", keep=()) -> DataFrame:
    """Whole-file texts → JSON documents (column ``doc``).

    A text with at least two non-blank lines that each parse on their own is
    NDJSON: every line becomes a one-member list document, so its objects follow
    the list rule (R2). Anything else is one document (a value spread over
    several lines always has a line that is not valid JSON by itself). Blank
    texts are dropped; a malformed document fails when it is parsed.
    """
    t = F.col(text_col)
    lines = F.filter(F.split(t, r"\r?\n"), lambda ln: _non_blank(ln))
    ndjson = (F.size(lines) >= 2) & F.forall(lines, lambda ln: F.try_parse_json(ln).isNotNull())
    kept = [F.col(k) for k in keep]
    members = F.transform(lines, lambda ln: F.concat(F.lit("["), ln, F.lit("]")))
    docs = F.when(ndjson, members).otherwise(F.array(t))
    return raw.where(_non_blank(t)).select(*kept, F.explode(docs).alias("doc"))


def _text(spark: SparkSession, path: str, glob: str, whole: bool) -> DataFrame:
    try:
        raw = spark.read.format("text").option("wholetext", whole).option("pathGlobFilter", glob).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise NotFound("path", path) from e
        raise
    return raw.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("_size"), "value")


def _large_arrays(spark: SparkSession, path: str, glob: str, limit: int) -> list[str]:
    """Names of the files above ``limit`` bytes that begin with a bracket (names only reach the driver)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")
    large = [r.path for r in files.filter(F.col("length") > limit).collect()]
    if not large:
        return []
    # the first text between braces of a file comes from its first range
    order = F.monotonically_increasing_id().alias("at")
    heads = (spark.read.format("text").option("lineSep", "}").load(large).where("_metadata.file_block_start = 0")
             .select(F.col("_metadata.file_path").alias("path"), F.substring(F.ltrim("value"), 1, 1).alias("head"), order)
             .groupBy("path").agg(F.min_by("head", "at").alias("head")))
    arrays = {_plain_path(r.path) for r in heads.where("head = '['").collect()}
    return [f for f in large if _plain_path(f) in arrays]


def _plain_path(path: str) -> str:
    """A path with one slash after its scheme: listings write ``file:/x`` and ``file:///x`` for the same file."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def read_json_files(spark: SparkSession, paths, *,
                    document_globs=("*.json",),
                    line_globs=("*.jsonl", "*.ndjson"),
                    split_above: int | None = None) -> DataFrame:
    """JSON documents from files and directories, as ``(source_file, doc)``.

    Files matching ``document_globs`` (default ``*.json``) are read whole, one task per file, and split by
    ``documents_from_text`` (one document, or NDJSON lines); those above ``split_above`` bytes (default: the
    session's ``spark.sql.files.maxPartitionBytes``) that hold an array are read by several tasks each
    (``json_ranges``), each member a one-member list document. Files matching ``line_globs`` (default
    ``*.jsonl``, ``*.ndjson``) are read line by line, so large files split across tasks; each line is a
    one-member list document (R2). Blank files/lines are skipped and JSON ``null`` documents are dropped
    by ``json_rows``.
    """
    if isinstance(paths, str):
        paths = [paths]
    limit = split_above
    if limit is None:
        limit = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    frames = []
    for p in paths:
        for glob in document_globs:
            raw = _text(spark, p, glob, True)
            large = _large_arrays(spark, p, glob, limit)
            if large:
                frames.append(array_documents(spark, large))
                names = [_plain_path(f) for f in large]
                raw = raw.where((F.col("_size") <= limit) | ~F.regexp_replace("source_file", r"^(\w+):/+", "$1:/").isin(names))
            frames.append(documents_from_text(raw, "value", keep=["source_file"]))
        for glob in line_globs:
            raw = _text(spark, p, glob, False)
            frames.append(raw.where(_non_blank(F.col("value"))).select(
                "source_file", F.concat(F.lit("["), F.col("value"), F.lit("]")).alias("doc")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
