"""JSON records to staging rows, with refused records kept apart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from simmart import schemas
from simmart.functions.coerce import Field, coerce, fault, json_schema, leaf_kind, leaf_text

ENVELOPE = (
    "page_meta struct<total_count: bigint>, chembl_id_lookups array<string>, molecules array<string>"
)


def _records(page: Column) -> Column:
    """The first list of records, unless that is empty or missing: the second."""
    first, second = page["chembl_id_lookups"], page["molecules"]
    return F.coalesce(F.when(F.size(first) > 0, first), second, first)


def unnest_pages(pages: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record of each page envelope, as JSON text, with the page's
    total. A page without a list of records gives no row; ``page_faults`` tells
    which pages those are."""
    page = pages.withColumn("_page", F.from_json(F.col(body), ENVELOPE))
    records = F.coalesce(_records(F.col("_page")), F.array().cast("array<string>"))
    return page.select(
        *keep, F.col("_page.page_meta.total_count").alias("total_count"), F.explode(records).alias("record")
    )


def page_faults(pages: DataFrame, rows: int, keep: tuple[str, ...] = ("page_offset",)) -> DataFrame:
    """Pages that are lost or broken, hold no list of records, or fewer records
    than the total implies: the kept columns, reason and n_records. Only the
    records of short pages can be used. Columns of the pages: page_offset,
    status, body, problem, and page_rows if pages may be of less than rows."""
    page = pages.withColumn("_page", F.from_json("body", ENVELOPE)).withColumn("_list", _records(F.col("_page")))
    total = F.col("_page.page_meta.total_count")
    own = F.coalesce("page_rows", F.lit(rows)) if "page_rows" in pages.columns else F.lit(rows)
    due = F.least(own, F.lit(rows), total - F.col("page_offset"))
    found = F.size("_list")
    reason = (
        F.when(F.col("status") != "ok", F.concat(F.lit("lost: "), F.coalesce("problem", F.lit("unknown"))))
        # Null unless the text is one complete object: the parser alone would
        # accept the start of a broken one.
        .when(F.json_object_keys("body").isNull(), "broken: not a JSON object")
        .when(F.col("_list").isNull() & (F.coalesce(total, F.lit(1)) > 0), "no list of records")
        .when(found < due, F.format_string("short: %d of %d records", found, due))
    )
    usable = F.when(reason.startswith("short"), found).otherwise(0).cast("bigint")
    judged = page.select(*keep, reason.alias("reason"), usable.alias("n_records"))
    return only(judged, F.col("reason").isNotNull())


def only(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition, as a generator that yields one row or
    none. A filter would be pushed below the projections it rests on and
    repeat the whole parse of the record inside its condition."""
    return df.select(F.inline(F.when(condition, F.array(F.struct(*df.columns)))))


@dataclass(frozen=True)
class _Block:
    """Fields found under one path of the parsed record, in the columns
    ``tag_name`` (value), ``tag_name_text`` and ``tag_name_kind``."""

    fields: list[Field]
    path: str
    tag: str
    label: str = ""

    def leaves(self) -> list[str]:
        found = []
        for f in self.fields:
            at = f"{self.path}.{f.name}"
            found += [f"{leaf_text(at)} AS {self.tag}_{f.name}_text", f"{leaf_kind(at)} AS {self.tag}_{f.name}_kind"]
        return found

    def values(self) -> list[str]:
        found = []
        for f in self.fields:
            name = f"{self.tag}_{f.name}"
            found += [f"{coerce(f'{name}_text', f'{name}_kind', f.dtype)} AS {name}", f"{name}_kind"]
        return found

    def faults(self) -> list[str]:
        return [
            fault(f"{self.tag}_{f.name}", f"{self.tag}_{f.name}_kind", f, f"{self.label}{f.name}") for f in self.fields
        ]

    def names(self) -> list[str]:
        return [f"{self.tag}_{f.name} AS {f.name}" for f in self.fields]


def _judged(parsed: DataFrame, blocks: list[_Block], keep: list[str]) -> DataFrame:
    """Text and kind of each leaf, then its value: every column is used
    several times further on, so Spark keeps the two steps apart."""
    leaves = parsed.selectExpr(*keep, *[e for b in blocks for e in b.leaves()])
    return leaves.selectExpr(*keep, *[e for b in blocks for e in b.values()])


def _parsed(records: DataFrame, column: str, schema: list[str]) -> DataFrame:
    """Leaves as columns. ``_whole`` is null unless the text is one complete
    JSON object: the parser alone would accept the start of a broken one."""
    whole = F.json_object_keys(F.col(column)).alias("_whole")
    leaves = F.from_json(F.col(column), ", ".join(schema)).alias("_r")
    return records.select("*", leaves, whole)


def _found(faults: list[str]) -> str:
    listed = f"array_compact(array({', '.join(faults)}))"
    return f"CASE WHEN _whole IS NULL THEN array('not a JSON object') ELSE {listed} END AS faults"


def check_lookups(records: DataFrame, column: str = "record") -> DataFrame:
    """Lookup columns plus ``faults``; an accepted record has none."""
    block = _Block(schemas.LOOKUP, "_r", "f")
    parsed = _parsed(records, column, json_schema(schemas.LOOKUP))
    judged = _judged(parsed, [block], [*records.columns, "_whole"])
    return judged.selectExpr(*records.columns, *block.names(), _found(block.faults()))


def check_molecules(records: DataFrame, column: str = "record") -> DataFrame:
    """Nested typed columns (chembl_id, dictionary, properties, structures)
    plus ``faults``. The sub-objects are null unless the record has them; an
    empty one is kept as a row of nulls."""
    ident = _Block([schemas.RECORD_ID], "_r", "i")
    dictionary = _Block(schemas.DICTIONARY, "_r", "d")
    subs = {
        "properties": _Block(schemas.PROPERTIES, "_r.molecule_properties", "p", "molecule_properties."),
        "structures": _Block(schemas.STRUCTURES, "_r.molecule_structures", "s", "molecule_structures."),
    }
    schema = json_schema([schemas.RECORD_ID, *schemas.DICTIONARY])
    flags, outputs, faults = [], [], [*ident.faults(), *dictionary.faults()]
    for name, block in subs.items():
        key = f"molecule_{name}"
        inner = ", ".join(f"{f.name}: variant" for f in block.fields)
        schema.append(f"{key} struct<{inner}>")
        given = F.get_json_object(column, f"$.{key}").isNotNull().alias(f"_given_{name}")
        flags += [given, F.expr(f"_r.{key} IS NOT NULL").alias(f"_has_{name}")]
        outputs.append(f"CASE WHEN _has_{name} THEN struct({', '.join(block.names())}) END AS {name}")
        wrong = f"CASE WHEN _given_{name} AND NOT _has_{name} THEN '{key}: not an object' END"
        faults += [wrong, *block.faults()]

    parsed = _parsed(records, column, schema).select("*", *flags)
    keep = [*records.columns, "_whole", *[f"_{flag}_{name}" for name in subs for flag in ("given", "has")]]
    judged = _judged(parsed, [ident, dictionary, *subs.values()], keep)
    return judged.selectExpr(
        *records.columns,
        "i_molecule_chembl_id AS chembl_id",
        f"struct({', '.join(dictionary.names())}) AS dictionary",
        *outputs,
        _found(faults),
    )


def accepted(checked: DataFrame, *columns: str) -> DataFrame:
    """The columns of records without a fault. They are chosen first, so that
    a scan of stored records reads no others."""
    return only(checked.select(*columns, "faults"), F.size("faults") == 0).drop("faults")


def refused(checked: DataFrame, column: str = "record") -> DataFrame:
    """(record, faults) of the records that were not accepted."""
    return only(checked.select(column, "faults"), F.size("faults") > 0)


def lookup_table(checked: DataFrame) -> DataFrame:
    return accepted(checked, *[f.name for f in schemas.LOOKUP])


def dictionary_table(checked: DataFrame) -> DataFrame:
    return accepted(checked, "chembl_id", "dictionary").select("chembl_id", "dictionary.*")


def properties_table(checked: DataFrame) -> DataFrame:
    found = accepted(checked, "chembl_id", "properties")
    return found.where("properties is not null").select("chembl_id", "properties.*")


def structures_table(checked: DataFrame) -> DataFrame:
    found = accepted(checked, "chembl_id", "structures")
    return found.where("structures is not null").select("chembl_id", "structures.*")


def nan_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN becomes null in the given columns of numbers or lists of numbers."""

    def number(value: Column) -> Column:
        return F.when(~F.isnan(value), value)

    kinds = dict(df.dtypes)
    lists = {c: kinds[c].startswith("array") for c in columns}
    return df.withColumns({c: F.transform(c, number) if lists[c] else number(F.col(c)) for c in columns})
