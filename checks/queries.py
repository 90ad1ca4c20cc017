"""The operators, run over the whole test tables.

The tables stand in for molecules: ``documents`` and ``benchmark`` texts are
structure strings, ``lineitem`` is the fact (source = l_suppkey, target =
l_partkey, score = discount per cent in sixteenths), ``part`` the molecule
properties. Scores and properties are binary fractions, so that sums are exact
in any order and averages compare without rounding.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from simmart.functions.fingerprint import N_BITS, fingerprint, n_set, pack
from simmart.functions.text import month_prefix
from simmart.operators import dedup, normalize, quality, similarity, targets, versions
from simmart.plans import ingest, mart, views
from simmart.session import shared_dir, tune
from simmart.sources import files, paged, ranges
from simmart.sources.tables import spread, table

PIVOT = [1, 2, 3, 5, 8, 13, 21, 34, 55, 89]


def _any_text(text: Column) -> Column:
    """Prose is no structure string; only empty text is refused here."""
    return F.length(text) > 0


# --- fingerprints and scoring


def fingerprint_bits(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", fingerprint(F.col("text"), valid=_any_text).alias("fingerprint"))


def fingerprint_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Sign bits of the vectors, then the same mirrored; label 0 gets a digit
    that is no bit."""
    sign = F.array_join(F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0")), "")
    text = F.when(F.col("label") == 0, F.concat(F.lit("2"), sign)).otherwise(F.concat(sign, F.reverse(sign)))
    words = table(spark, sf, "embeddings").select("vec_id", pack(text).alias("words"))
    return words.select(
        "vec_id",
        F.get("words", F.lit(0)).alias("word_1"),
        F.get("words", F.lit(1)).alias("word_2"),
        F.coalesce(n_set(F.col("words")), F.lit(-1)).alias("n_set"),
    )


def fingerprint_scan(spark: SparkSession, sf: str) -> DataFrame:
    return files.fingerprint_files(spark, f"{sf}/documents.parquet", "doc_id bigint, text string", "text")


def fingerprint_file_faults(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as a store of eight parts, some of which cannot be used:
    another column name, another type, other settings, and plain text. Parts
    with their rows and faults, and the rows that a read of the others gives.
    Each task writes its own rows, so that a part has as many files as there
    were tasks with rows of it."""
    folder = f"{shared_dir(spark)}/prints-{uuid.uuid4().hex}"
    docs, own = table(spark, sf, "documents").select("doc_id", "text", "n_chars"), F.pmod("doc_id", F.lit(8)).cast("int")
    made = {"radius": 2, "n_bits": 2048}
    id_, text = F.col("doc_id"), F.col("text").alias("text", metadata=made)
    shapes = {
        1: [id_, F.col("text").alias("smiles", metadata=made)],
        2: [id_, F.col("n_chars").alias("text", metadata=made)],
        3: [id_, F.col("text").alias("text", metadata=made | {"radius": 3})],
        5: [F.col("doc_id").cast("string").alias("doc_id"), text],
    }
    for part in (0, 1, 2, 3, 5, 6, 7):
        docs.where(own == part).select(*shapes.get(part, [id_, text])).write.parquet(f"{folder}/part={part}")
    docs.where(own == 4).select(F.coalesce("text", F.lit(""))).write.text(f"{folder}/part=4")
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for found in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part=4")):
        name = found.getPath().toString()
        if name.endswith(".txt"):
            fs.rename(found.getPath(), spark._jvm.org.apache.hadoop.fs.Path(name[:-4] + ".parquet"))
    schema = "doc_id bigint, text string"
    audit = files.file_audit(spark, folder, schema, made)
    part = F.regexp_extract("file", r"part=(\d)/", 1).cast("int").alias("part")
    read = files.fingerprint_files(spark, folder, schema, "text", placed=True, only=files.usable_files(audit))
    rows = read.groupBy(part).agg(F.count("*").alias("rows_read"))
    fault = F.regexp_replace("fault", r"(:| \{).*", "").alias("fault")
    return audit.groupBy(part, fault).agg(F.sum("n_rows").alias("n_rows")).join(rows, "part", "left")


def structure_scan(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("chembl_id"), F.col("text").alias("canonical_smiles")
    )


def split_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All events, read in sixteen ranges of an id that is skewed: the seventh
    power of a small number, times a large one, and the event's own number.
    Each row with whether its range is no larger than 1.5 times the mean."""
    skewed = F.pow(F.col("event_id") % 20, 7).cast("bigint") * 1_000_000_000 + F.col("event_id")
    events = table(spark, sf, "events").select("event_id", skewed.alias("skewed_id"), "event_type")
    cut = ranges.quantile_ranges(events, "skewed_id", 16)
    rows = ranges.read_ranges(events, "skewed_id", cut, "split")
    sizes = rows.groupBy("split").agg(F.count("*").alias("n"))
    mean = sizes.agg(F.sum("n") / len(cut)).first()[0]
    return rows.join(sizes.select("split", (F.col("n") <= 1.5 * mean).alias("even")), "split").drop("split")


def limit_offset(spark: SparkSession, sf: str) -> DataFrame:
    return structure_scan(spark, sf).orderBy("chembl_id").offset(100).limit(150)


def _molecules(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Targets (all benchmark items) and sources (all documents and items), as
    (chembl_id, words). Targets are among the sources, as in a real month."""
    items = table(spark, sf, "benchmark").select(F.concat(F.lit("item-"), "item_id").alias("chembl_id"), "text")
    docs = table(spark, sf, "documents").select(F.concat(F.lit("doc-"), "doc_id").alias("chembl_id"), "text")

    def words(df: DataFrame) -> DataFrame:
        bits = fingerprint(F.col("text"), valid=_any_text)
        return df.select("chembl_id", pack(bits, N_BITS).alias("words"))

    return words(spread(items)), words(spread(docs).unionByName(items))


def tanimoto_full(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.pair_scores(*_molecules(spark, sf))


def tanimoto_topk(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.top_similar(*_molecules(spark, sf))


def tanimoto_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Ranked from all scores rather than from each task's best."""
    return similarity.top_of_all(*_molecules(spark, sf))


def tanimoto_banded(spark: SparkSession, sf: str) -> DataFrame:
    """Of sources stored in bands of set-bit counts, in two rounds."""
    targets, sources = _molecules(spark, sf)
    store = f"{shared_dir(spark)}/bands-{uuid.uuid4().hex}"
    similarity.write_bands(sources, store)
    return similarity.top_similar_stored(targets, similarity.read_bands(spark, store))


# --- target files


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Each document as one target file."""
    return files.text_lines(table(spark, sf, "documents"), "doc_id", "text")


def csv_clean(spark: SparkSession, sf: str) -> DataFrame:
    return targets.molecules(_lines(spark, sf))


def csv_reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return targets.refused_lines(_lines(spark, sf)).select("file", "line", "reason")


def monthly_targets(spark: SparkSession, sf: str) -> DataFrame:
    return targets.monthly_targets(_lines(spark, sf))


def target_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return targets.refused_targets(targets.monthly_targets(_lines(spark, sf)))


def month_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", month_prefix(F.col("o_orderdate")).alias("prefix"))


# --- duplicates and checks


def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return dedup.keep_first(events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


def duplicate_members(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    return dedup.duplicate_members(events, ["user_id", "value"])


def count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return quality.count_distinct(table(spark, sf, "documents"), "doc_id")


def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.reconcile(table(spark, sf, "documents"), "doc_id", table(spark, sf, "labels"))


def version_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that have lines against the orders themselves, in six versions
    by order number. Of the orders, versions 0 to 2 hold just those with lines,
    3 holds all, 4 only the finished ones, and 5 is not there."""
    version = F.col("key") % 6
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key")).withColumn("version", version)
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus").withColumn("version", version)
    stage = f"{shared_dir(spark)}/versions-{uuid.uuid4().hex}"
    lined = orders.where("version < 3").join(lines.where("version < 3"), "key", "left_semi")
    held = lined.unionByName(orders.where("version = 3 or version = 4 and o_orderstatus = 'F'"))
    sides = []
    for name, rows in (("lines", lines), ("orders", held.drop("o_orderstatus"))):
        rows.write.partitionBy("version").parquet(f"{stage}/{name}")
        kept = spark.read.schema("key bigint, version bigint").parquet(f"{stage}/{name}")
        versions.key_sketches(kept, "key", ["version"]).write.parquet(f"{stage}/{name}_sketches")
        sides.append((kept, spark.read.parquet(f"{stage}/{name}_sketches")))
    (expected, es), (actual, own) = sides
    found = versions.reconciled(expected, actual, "key", "version", es, own)
    return found.select("version", "checked", "n_missing", "n_extra")


def pk_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.primary_key_violations(table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"])


def fk_violations(spark: SparkSession, sf: str) -> DataFrame:
    lines, people = table(spark, sf, "lineitem"), table(spark, sf, "customer")
    target = quality.foreign_key_violations(lines, "l_partkey", people, "c_custkey")
    return target.unionByName(quality.foreign_key_violations(lines, "l_suppkey", people, "c_custkey"))


# --- records


def paged_scan(spark: SparkSession, sf: str) -> DataFrame:
    fetcher = paged.ParquetPages(f"{sf}/pages.parquet", ["page_id", "url", "html"])
    fetched = paged.pages(spark, fetcher, rows=100, name="web_pages")
    records = normalize.unnest_pages(paged.good_pages(fetched))
    page = F.from_json("record", "page_id bigint, url string, html string").alias("page")
    return records.select(page, "total_count").select("page.*", "total_count")


def json_envelope_unnest(spark: SparkSession, sf: str) -> DataFrame:
    """Each document as one page, each line as one record. English pages fill
    the first list, French ones only the second; the others have an empty
    first list, and Spanish ones a second that is no list."""
    records = F.transform(F.split("text", F.lit("\n")), lambda line: F.struct(line.alias("line")))
    lang = F.col("lang")
    meta = F.struct(F.size(records).cast("bigint").alias("total_count")).alias("page_meta")
    none = F.array().cast("array<struct<line:string>>")
    body = (
        F.when(lang == "en", F.to_json(F.struct(meta, records.alias("chembl_id_lookups"))))
        .when(lang == "fr", F.to_json(F.struct(meta, records.alias("molecules"))))
        .when(
            lang == "es",
            F.to_json(F.struct(meta, none.alias("chembl_id_lookups"), F.lit("none").alias("molecules"))),
        )
        .otherwise(F.to_json(F.struct(meta, none.alias("chembl_id_lookups"), records.alias("molecules"))))
    )
    pages = table(spark, sf, "documents").select("doc_id", body.alias("body"))
    rows = normalize.unnest_pages(pages, keep=("doc_id",))
    return rows.select("doc_id", "total_count", F.get_json_object("record", "$.line").alias("line"))


def page_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Each document as the page of one offset, and its lines as the records;
    one page in ten is lost, cut off, without a list, or short by a record."""
    lines = F.transform(F.split("text", F.lit("\n")), lambda line: F.struct(line.alias("line")))
    case = F.col("doc_id") % 10
    last = F.when(case == 4, 1).otherwise(0)
    total = F.struct((F.size(lines) + F.col("doc_id")).cast("bigint").alias("total_count")).alias("page_meta")
    some = F.slice(lines, F.lit(1), F.size(lines) - last)
    whole = F.to_json(F.struct(total, some.alias("molecules")))
    body = (
        F.when(case == 1, F.lit(None))
        .when(case == 2, F.substring(whole, F.lit(1), F.length(whole) - 1))
        .when(case == 3, F.to_json(F.struct(total, F.lit("none").alias("molecules"))))
        .otherwise(whole)
    )
    pages = table(spark, sf, "documents").select(
        F.col("doc_id").alias("page_offset"),
        F.when(case == 1, "lost").otherwise("ok").alias("status"),
        body.alias("body"),
        F.when(case == 1, "timeout").alias("problem"),
    )
    faults = normalize.page_faults(pages, rows=2**31 - 1)
    kinds = faults.groupBy(F.regexp_extract("reason", "^[a-z ]+", 0).alias("kind"))
    bad = kinds.agg(F.count("*").alias("n_pages"), F.sum("n_records").alias("n_records"))
    records = normalize.unnest_pages(paged.good_pages(pages), keep=("page_offset",))
    all_ = records.agg(F.countDistinct("page_offset").alias("n_pages"), F.count("*").alias("n_records"))
    return bad.unionByName(all_.withColumn("kind", F.lit("with records")))


def staging_key_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Four tables as staging tables, three of them with keys that repeat."""
    keys = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_suppkey"], "labels": ["doc_id"], "conversations": ["conv_id"]}
    return ingest.staging_key_violations({name: table(spark, sf, name) for name in keys}, keys)


def json_validate(spark: SparkSession, sf: str) -> DataFrame:
    """Events as lookup records whose last_active is a number, a number as
    text, or text; and whose status is missing, null, or a number."""
    kind, value = F.col("event_type"), F.col("value").cast("string")
    last = (
        F.when(F.col("value") < 1, F.lit('"n/a"'))
        .when(F.col("value") < 5, F.concat(F.lit('" '), value, F.lit('"')))
        .when(F.col("value") < 6, F.lit("null"))
        .otherwise(value)
    )
    status = (
        F.when(kind == "error", "")
        .when(F.col("user_id") % 10 == 0, ', "status": null')
        .when(F.col("user_id") % 10 == 1, ', "status": 7')
        .otherwise(', "status": "ACTIVE"')
    )
    record = F.format_string(
        '{"chembl_id": "E%s", "entity_type": "%s", "last_active": %s, "resource_url": "/e/%s"%s, "more": [1]}',
        "event_id", kind, last, "event_id", status,
    )
    checked = normalize.check_lookups(table(spark, sf, "events").select("event_id", record.alias("record")))
    return checked.select(
        "event_id", "chembl_id", "entity_type", "last_active", "status",
        F.array_join("faults", "; ").alias("faults"),
    )


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, with their labels where there are any, as nested records."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    joined = docs.join(labels, "doc_id", "left")
    properties = F.when(
        F.col("quality").isNotNull(),
        F.struct(
            F.col("quality").cast("string").alias("alogp"),
            F.col("toxic").alias("heavy_atoms"),
            F.lit("NULL").alias("cx_most_apka"),
        ),
    )
    structures = F.when(
        F.col("lang") != "de", F.struct(F.col("text").alias("canonical_smiles"), F.lit(None).alias("molfile"))
    )
    record = F.struct(
        F.concat(F.lit("M"), "doc_id").alias("molecule_chembl_id"),
        F.col("lang").alias("molecule_type"),
        F.col("source").alias("pref_name"),
        F.col("n_chars").alias("chirality"),
        (F.col("n_chars") % 2).alias("oral"),
        (F.col("n_chars") / 4).alias("usan_year"),
        F.lit(-1).alias("orphan"),
        properties.alias("molecule_properties"),
        structures.alias("molecule_structures"),
    )
    return normalize.check_molecules(joined.select(F.to_json(record).alias("record")))


def normalize_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.dictionary_table(_records(spark, sf)).select(
        "chembl_id", "molecule_type", "pref_name", "chirality", "oral", "usan_year", "orphan"
    )


def normalize_properties(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.properties_table(_records(spark, sf)).select("chembl_id", "alogp", "heavy_atoms", "cx_most_apka")


def normalize_structures(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.structures_table(_records(spark, sf)).select("chembl_id", "canonical_smiles")


def nan_to_null(spark: SparkSession, sf: str) -> DataFrame:
    """Every element of every vector; negative ones stand for NaN."""
    nan = F.lit(float("nan")).cast("double")
    values = F.transform("embedding", lambda x: F.when(x < 0, nan).otherwise(x.cast("double")))
    clean = normalize.nan_to_null(table(spark, sf, "embeddings").select("vec_id", values.alias("values")), ["values"])
    return clean.select("vec_id", F.posexplode("values").alias("place", "value"))


# --- mart and views


def _pairs(lines: DataFrame) -> DataFrame:
    return lines.groupBy(
        F.col("l_suppkey").alias("source_chembl_id"), F.col("l_partkey").alias("target_chembl_id")
    ).agg(F.max(F.round(F.col("l_discount") * 100) / 16).alias("tanimoto_similarity"))


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(table(spark, sf, "lineitem"))


def _properties(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as molecules; small parts lack rings and alogp."""
    small = F.col("p_type") == "SMALL"
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("chembl_id"),
        F.when(~small, F.length("p_type").cast("double")).alias("aromatic_rings"),
        F.col("p_size").cast("double").alias("heavy_atoms"),
        F.when(~small, F.round(F.col("p_retailprice") * 100)).alias("alogp"),
    )


def avg_score(spark: SparkSession, sf: str) -> DataFrame:
    return views.average_score(_fact(spark, sf))


def avg_deviation(spark: SparkSession, sf: str) -> DataFrame:
    return views.average_deviation(_fact(spark, sf), _properties(spark, sf))


def pivot_scores(spark: SparkSession, sf: str) -> DataFrame:
    return views.pivot_scores(_fact(spark, sf), PIVOT).withColumnsRenamed({str(i): f"source_{i}" for i in PIVOT})


def next_most_similar(spark: SparkSession, sf: str) -> DataFrame:
    """A fact in which one score in eleven is null."""
    score = F.nullif("tanimoto_similarity", F.lit(5 / 16))
    return views.next_most_similar(_fact(spark, sf).withColumn("tanimoto_similarity", score))


def grouped_averages(spark: SparkSession, sf: str) -> DataFrame:
    return views.grouped_averages(_fact(spark, sf), _properties(spark, sf))


def fact_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The lines 1-4 of the orders are the old fact, the others the new rows."""
    lines, late = table(spark, sf, "lineitem"), F.col("l_linenumber") > 4
    old, new = _pairs(lines.where(~late)), _pairs(lines.where(late))
    path = f"{shared_dir(spark)}/fact-{uuid.uuid4().hex}"
    schema = "source_chembl_id bigint, target_chembl_id bigint, tanimoto_similarity double"
    for rows in (old, new):
        mart.put(spark, path, rows, mart.FACT_KEYS, schema)
    return mart.read(spark, path, schema)


def key_union(spark: SparkSession, sf: str) -> DataFrame:
    return mart.keys_in_fact(_fact(spark, sf))


def dim_molecules(spark: SparkSession, sf: str) -> DataFrame:
    """Parts are the properties, orders the dictionary, lines the fact."""
    price = F.col("p_retailprice").cast("string")
    properties = table(spark, sf, "part").select(
        F.col("p_partkey").alias("chembl_id"),
        price.alias("mw_freebase"),
        F.when(F.col("p_size") > 25, "NULL").otherwise(price).alias("alogp"),
        F.col("p_size").cast("string").alias("psa"),
        F.lit("1e3").alias("cx_logp"),
        F.col("p_type").alias("molecular_species"),
        price.alias("full_mwt"),
        (F.col("p_size") / 2).alias("aromatic_rings"),
        (F.col("p_size") + 0.25).alias("heavy_atoms"),
    )
    dictionary = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("chembl_id"), F.col("o_orderstatus").alias("molecule_type")
    )
    return mart.dim_rows(properties, dictionary, _fact(spark, sf))


QUERIES = {
    "fingerprint_bits": fingerprint_bits,
    "fingerprint_decode": fingerprint_decode,
    "fingerprint_scan": fingerprint_scan,
    "fingerprint_file_faults": fingerprint_file_faults,
    "structure_scan": structure_scan,
    "split_scan": split_scan,
    "limit_offset": limit_offset,
    "tanimoto_full": tanimoto_full,
    "tanimoto_topk": tanimoto_topk,
    "tanimoto_postings": tanimoto_postings,
    "tanimoto_banded": tanimoto_banded,
    "csv_clean": csv_clean,
    "csv_reject_reasons": csv_reject_reasons,
    "monthly_targets": monthly_targets,
    "target_rejects": target_rejects,
    "month_prefix": month_prefixes,
    "dedup_keep_first": dedup_keep_first,
    "duplicate_members": duplicate_members,
    "count_distinct": count_distinct,
    "reconcile_counts": reconcile_counts,
    "version_reconcile": version_reconcile,
    "pk_violations": pk_violations,
    "fk_violations": fk_violations,
    "paged_scan": paged_scan,
    "json_envelope_unnest": json_envelope_unnest,
    "page_reconcile": page_reconcile,
    "staging_key_violations": staging_key_violations,
    "json_validate": json_validate,
    "normalize_dictionary": normalize_dictionary,
    "normalize_properties": normalize_properties,
    "normalize_structures": normalize_structures,
    "nan_to_null": nan_to_null,
    "avg_score": avg_score,
    "avg_deviation": avg_deviation,
    "pivot_scores": pivot_scores,
    "next_most_similar": next_most_similar,
    "grouped_averages": grouped_averages,
    "fact_upsert": fact_upsert,
    "key_union": key_union,
    "dim_molecules": dim_molecules,
}


def tuned(query):
    """The query on a session with the settings it relies on."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return query(tune(spark), sf)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run
