"""Mappings from several kinds of sources in one long form: source, code, label, target, confidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.columns import c, lookup, norm_key

FIELDS = ("code", "label", "target", "confidence")


def evidence(parts: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """(source, code, label, target, confidence) of tables whose columns are named by field; a field that
    a source lacks is null; rows without a code or target go, repeated ones stay once."""
    out = None
    for source, (df, columns) in parts.items():
        made = [(norm_key(c(columns[f])) if f == "code" else c(columns[f]).cast("string")).alias(f) if f in columns else F.lit(None).cast("string").alias(f) for f in FIELDS]
        one = df.select(F.lit(source).alias("source"), *made).filter("code <> '' and target is not null")
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def insert_statements(lines: DataFrame, text: str, n_columns: int) -> DataFrame:
    """c0, c1, ... of the rows of SQL `INSERT ... VALUES (...), (...)` texts; quotes are taken off, NULL is null.
    A quoted value may hold commas and doubled quotes."""
    value = r"(?:'(?:[^']|'')*'|[^,()']*)"
    rows = F.regexp_extract_all(c(text), F.lit(r"\(\s*(" + value + r"(?:\s*,\s*" + value + r"){" + str(n_columns - 1) + r"})\s*\)"), F.lit(1))
    inside = lines.filter(F.lower(c(text)).contains("insert")).select(F.explode(rows).alias("r"))
    cells = F.regexp_extract_all("r", F.lit(r"\s*(" + value + r")\s*(?:,|$)"), F.lit(1))
    bare = F.transform(cells, lambda v: F.when(F.upper(F.trim(v)) == "NULL", F.lit(None)).otherwise(F.replace(F.regexp_replace(F.trim(v), r"^'|'$", ""), F.lit("''"), F.lit("'"))))
    return inside.select(bare.alias("v")).select(*[F.get("v", F.lit(i)).alias(f"c{i}") for i in range(n_columns)])


# The long form's columns, and the source tables whose names sources and vocabularies begin with.
LONG = (
    "source", "file", "role", "source_table", "itemid", "valueid", "unitid", "ordercategoryid", "code", "vocabulary", "label", "value", "unit",
    "target_vocabulary", "target_concept", "target_code", "target_label", "status", "equivalence", "match", "note", "keyed_by",
)
KEYS = ("code", "itemid", "valueid", "unitid", "ordercategoryid", "target_concept")
TABLES = ("numericitems", "listitems", "drugitems", "freetextitems", "processitems", "procedureorderitems")


@dataclass(frozen=True)
class Adapter:
    """How one kind of file becomes the long form: its role and way of matching, field -> columns of which the
    first that isn't empty holds, note: columns put together, table: columns that name the source table,
    else it is the file's name; coded: whether `code` is item-suffix and its suffix is typed by the table."""

    role: str
    match: str
    fields: Mapping[str, tuple[str, ...]]
    note: tuple[str, ...] = ()
    table: tuple[str, ...] = ()
    coded: bool = False
    keyed_by: str = "columns"


# The columns of the eight kinds of mapping files, and of the vocabulary's own list of versions.
ADAPTERS: dict[str, Adapter] = {
    "usagi": Adapter("standard_mapping", "usagi", {"code": ("sourceCode",), "label": ("sourceName",), "target_concept": ("conceptId",), "target_label": ("conceptName",), "status": ("mappingStatus",), "equivalence": ("equivalence",)}, ("comment", "matchScore"), coded=True),
    "concept_map": Adapter("standard_mapping", "source_to_concept", {"code": ("source_code",), "vocabulary": ("source_vocabulary_id",), "label": ("source_code_description",), "target_vocabulary": ("target_vocabulary_id",), "target_concept": ("target_concept_id",), "status": ("invalid_reason",)}, table=("source_vocabulary_id",), coded=True),
    "value_map": Adapter("value_mapping", "source_to_value", {"code": ("SOURCE_CODE",), "vocabulary": ("SOURCE_VOCABULARY_ID",), "label": ("SOURCE_CODE_DESCRIPTION",), "value": ("VALUE",)}, ("ROW",), ("SOURCE_VOCABULARY_ID",), True),
    "source_concepts": Adapter("source_metadata", "source_concept", {"itemid": ("itemid",), "valueid": ("valueid",), "unitid": ("unitid",), "ordercategoryid": ("ordercategoryid",), "code": ("source_concept_id",), "vocabulary": ("vocabulary_id",), "label": ("source_concept", "item"), "value": ("value",), "unit": ("unit",), "target_vocabulary": ("vocabulary_id",), "target_concept": ("concept_id",), "target_code": ("vocabulary_concept_code",), "target_label": ("concept_name", "vocabulary_concept_name")}, ("category", "ordercategory", "ucum_code"), ("table",)),
    "dictionary": Adapter("standard_mapping", "dictionary", {"code": ("source_code",), "vocabulary": ("source_vocabulary_id",), "label": ("source_code_description",), "value": ("value_of_source_code",), "target_vocabulary": ("vocabulary_id",), "target_concept": ("concept_id",), "target_code": ("concept_code",), "target_label": ("concept_name",), "status": ("mapping_status",), "equivalence": ("equivalence",)}, ("value_of_concept_id",), ("source_vocabulary_id",), True),
    "old_dictionary": Adapter("source_metadata", "old_dictionary", {"itemid": ("itemid",), "valueid": ("valueid",), "unitid": ("unitid",), "ordercategoryid": ("ordercategoryid",), "code": ("itemid",), "vocabulary": ("vocabulary_id",), "label": ("item",), "value": ("value",), "unit": ("unit",)}, ("category", "ordercategory"), ("table",)),
    "flowsheet": Adapter("clinical_grouping", "insert", {"itemid": ("c0",), "code": ("c0",), "label": ("c1",)}, ("c2", "c3", "c4", "c5", "c6")),
    "context": Adapter("clinical_context", "label", {"label": ("label", "drugname", "ingredient"), "value": ("value", "dataset"), "target_concept": ("concept_id",), "target_label": ("blended",)}, ("categories", "unit_concept_id", "agg_method", "count"), keyed_by="label"),
    "vocabulary": Adapter("vocabulary_version", "vocabulary", {"target_vocabulary": ("vocabulary_id",), "target_concept": ("vocabulary_concept_id",), "target_label": ("vocabulary_name",)}, ("vocabulary_reference", "vocabulary_version"), keyed_by="vocabulary"),
}
# The kinds of rows in INSERT statements, by the table that they are of.
KINDS = {"numeric": "numericitems", "list": "listitems", "freetext": "freetextitems"}


def table_named(text: Column) -> Column:
    """The source table that a name begins with, after a prefix and a blank if it has one; else null."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"^\w+\s+", "")
    found = F.lit(None).cast("string")
    for name in TABLES:
        found = F.when(bare.startswith(name) | F.lower(text).startswith(name), name).otherwise(found)
    return found


def adapted(df: DataFrame, source: str, adapter: Adapter, file: str = "") -> DataFrame:
    """A file's rows in the long form, all texts. Columns that the file lacks, and empty texts, are null.

    A code item-suffix gives the item, and the suffix as category, value or unit by the source table:
    drugitems, listitems or freetextitems, numericitems; `keyed_by` says what was found. Rows without any
    of code, item, label and target go.
    """
    # Keys lose the words for nothing and a decimal .0; of other texts, which may be Na for sodium, only blanks are nothing.
    text = lambda name, key=False: F.nullif(norm_key(c(name)) if key else F.trim(c(name).cast("string")), F.lit("")) if name in df.columns else F.lit(None).cast("string")
    first = lambda names, key=False: F.coalesce(*[text(n, key) for n in names]) if names else F.lit(None).cast("string")
    made = {f: F.lit(None).cast("string") for f in LONG} | {f: first(names, f in KEYS) for f, names in adapter.fields.items()}
    if source == "flowsheet":
        table = lookup(F.lower(text("c6")), KINDS)
    else:
        table = F.coalesce(table_named(first(adapter.table)), table_named(F.lit(file.rsplit("/", 1)[-1])))
    keyed = F.lit(adapter.keyed_by)
    if adapter.coded:
        item, suffix = F.nullif(F.regexp_extract(made["code"], r"^(\d+)(?:-|$)", 1), F.lit("")), F.nullif(F.regexp_extract(made["code"], r"^\d+-(\d+)(?:-|$)", 1), F.lit(""))
        kind = F.when(suffix.isNull(), None).when(table == "drugitems", "ordercategoryid").when(table.isin("listitems", "freetextitems"), "valueid").when(table == "numericitems", "unitid").otherwise("suffix")
        made["itemid"] = item
        made |= {f: F.when(kind == f, suffix) for f in ("ordercategoryid", "valueid", "unitid")}
        keyed = F.when(item.isNull(), "nothing").when(kind.isNull(), "itemid").otherwise(F.concat(F.lit("itemid_"), kind))
    note = F.nullif(F.concat_ws("|", *[text(n) for n in adapter.note]), F.lit("")) if adapter.note else F.lit(None).cast("string")
    made |= {"source": F.lit(source), "file": F.lit(file), "role": F.lit(adapter.role), "source_table": table, "match": F.lit(adapter.match), "note": note, "keyed_by": keyed}
    rows = df.select(*[made[f].cast("string").alias(f) for f in LONG])
    return rows.filter(F.coalesce("code", "itemid", "label", "target_concept", "target_vocabulary").isNotNull())


def all_evidence(parts: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Every (kind of ADAPTERS, table, file) in the long form, with `evidence_id`, a hash of the row, so that it
    is the same in every build; repeated rows stay once."""
    long = reduce(lambda a, b: a.unionByName(b), [adapted(df, kind, ADAPTERS[kind], file) for kind, df, file in parts]).distinct()
    return long.select(F.sha2(F.concat_ws("\x1f", *[F.coalesce(f, F.lit("\x00")) for f in LONG]), 256).alias("evidence_id"), *LONG)
