import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from simmart import schemas
from simmart.functions.fingerprint import pack
from simmart.operators import normalize
from simmart.plans import ingest
from simmart.sources import paged

# The fields of both kinds of record.
LOOKUP = {
    "chembl_id": "CHEMBL1",
    "entity_type": "COMPOUND",
    "last_active": 34,
    "resource_url": "/data/molecule/CHEMBL1",
    "status": "ACTIVE",
}

MOLECULE = {
    "molecule_chembl_id": "CHEMBL414196",
    "availability_type": -1,
    "black_box_warning": 0,
    "chebi_par_id": None,
    "dosed_ingredient": False,
    "molecule_type": "Small molecule",
    "oral": False,
    "orphan": -1,
    "molecule_properties": {"alogp": "2.68", "aromatic_rings": 3, "cx_most_apka": "NULL", "hba": 7, "psa": "93.81"},
    "molecule_structures": {"canonical_smiles": "CCO", "molfile": "\n  2D\n", "standard_inchi_key": "QSRC"},
}


def records(spark, *items):
    texts = [i if isinstance(i, str) else json.dumps(i) for i in items]
    return spark.createDataFrame([(t,) for t in texts], "record string")


def lookup(spark, **changes):
    return normalize.check_lookups(records(spark, {**LOOKUP, **changes})).first()


def test_lookup_record(spark):
    row = lookup(spark)
    assert row.faults == [] and row.chembl_id == "CHEMBL1" and row.last_active == 34.0
    assert normalize.lookup_table(normalize.check_lookups(records(spark, LOOKUP))).columns == list(LOOKUP)


LOOKUP_FAULTS = [
    ({"status": "-"}, ["status: absent"]),
    ({"status": None}, ["status: required"]),
    ({"status": 5}, ["status: not a string"]),
    ({"last_active": None}, []),
    ({"last_active": "-"}, ["last_active: absent"]),
    ({"last_active": "2023-01-01"}, ["last_active: not a double"]),
    ({"last_active": " 12.5 "}, []),
    ({"last_active": "1d"}, ["last_active: not a double"]),
    ({"last_active": [1]}, ["last_active: not a double"]),
    ({"extra": {"a": 1}}, []),
]


def test_lookup_faults(spark):
    items = [{k: v for k, v in {**LOOKUP, **changes}.items() if v != "-"} for changes, _ in LOOKUP_FAULTS]
    found = normalize.check_lookups(records(spark, *items)).collect()
    assert [r.faults for r in found] == [faults for _, faults in LOOKUP_FAULTS]


def test_broken_json_is_refused(spark):
    texts = ["", "[1]", "5", "nope", '{"chembl_id": "A"', json.dumps(LOOKUP)[:-1]]
    checked = normalize.check_lookups(records(spark, *texts))
    assert [r.faults for r in checked.collect()] == [["not a JSON object"]] * len(texts)
    assert normalize.lookup_table(checked).count() == 0
    assert [r.record for r in normalize.refused(checked).collect()] == texts


@pytest.mark.parametrize("copies", [0, 2, 1000])
def test_record_splits_into_three_tables(spark, copies):
    rows = spark.range(copies).select(F.lit(json.dumps(MOLECULE)).alias("record"))
    checked = normalize.check_molecules(rows)
    tables = normalize.dictionary_table(checked), normalize.properties_table(checked), normalize.structures_table(checked)
    assert [t.count() for t in tables] == [copies] * 3


def test_columns_types_and_values(spark):
    checked = normalize.check_molecules(records(spark, MOLECULE))
    d, p, s = normalize.dictionary_table(checked), normalize.properties_table(checked), normalize.structures_table(checked)
    for df, fields in ((d, schemas.DICTIONARY), (p, schemas.PROPERTIES), (s, schemas.STRUCTURES)):
        assert [(c, t) for c, t in df.dtypes] == [("chembl_id", "string")] + [(f.name, f.dtype) for f in fields]
    assert d.columns[15:18] == ["oral", "orphan", "parenteral"]
    d, p, s = d.first(), p.first(), s.first()
    assert (d.chembl_id, d.availability_type, d.black_box_warning, d.oral, d.orphan) == ("CHEMBL414196", -1.0, 0, False, -1)
    assert d.chebi_par_id is None and d.usan_stem is None
    assert (p.alogp, p.aromatic_rings, p.cx_most_apka, p.rtb) == ("2.68", 3.0, "NULL", None)
    assert (s.canonical_smiles, s.molfile, s.standard_inchi) == ("CCO", "\n  2D\n", None)


def test_sub_object_presence(spark):
    items = []
    for i, sub in enumerate(["-", None, {}, {"hba": 1}]):
        item = {**MOLECULE, "molecule_chembl_id": f"M{i}", "molecule_properties": sub}
        if sub == "-":
            del item["molecule_properties"]
        items.append(item)
    checked = normalize.check_molecules(records(spark, *items))
    rows = normalize.properties_table(checked).select("chembl_id", "hba").collect()
    assert [tuple(r) for r in rows] == [("M2", None), ("M3", 1.0)]
    assert normalize.dictionary_table(checked).count() == 4


FAULTS = [
    ({"molecule_chembl_id": None}, "molecule_chembl_id: required"),
    ({"molecule_type": 3}, "molecule_type: not a string"),
    ({"oral": "maybe"}, "oral: not a boolean"),
    ({"chirality": 1.5}, "chirality: not a bigint"),
    ({"molecule_properties": [1]}, "molecule_properties: not an object"),
    ({"molecule_structures": "CCO"}, "molecule_structures: not an object"),
    ({"molecule_properties": {"alogp": 2.68}}, "molecule_properties.alogp: not a string"),
    ({"molecule_properties": {"hba": "x"}}, "molecule_properties.hba: not a double"),
]


def test_refused_records_leave_the_others(spark):
    checked = normalize.check_molecules(records(spark, *[{**MOLECULE, **changes} for changes, _ in FAULTS], MOLECULE))
    assert [r.faults for r in normalize.refused(checked).collect()] == [[fault] for _, fault in FAULTS]
    assert normalize.dictionary_table(checked).count() == 1
    assert normalize.structures_table(checked).count() == 1


LAX = [
    ("oral", 0, False), ("oral", 1, True), ("oral", 1.0, True), ("oral", "Yes", True), ("oral", "off", False),
    ("oral", True, True), ("oral", None, None), ("chirality", 3, 3), ("chirality", 3.0, 3), ("chirality", "5", 5),
    ("chirality", " 7 ", 7), ("chirality", True, 1), ("chirality", 2**40, 2**40), ("usan_year", "1.5", 1.5),
    ("usan_year", False, 0.0), ("usan_year", 1e30, 1e30),
]


def test_lax_values(spark):
    items = [{"molecule_chembl_id": f"M{i}", name: given} for i, (name, given, _) in enumerate(LAX)]
    rows = normalize.dictionary_table(normalize.check_molecules(records(spark, *items))).collect()
    assert [r[name] for r, (name, _, _) in zip(rows, LAX)] == [value for _, _, value in LAX]


def unnested(spark, *bodies):
    pages = spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b),) for b in bodies], "body string")
    return normalize.unnest_pages(pages).collect()


def test_envelopes(spark):
    meta = {"page_meta": {"total_count": 100}}
    rows = unnested(spark, {**meta, "chembl_id_lookups": [{"a": 1}, {"a": 2}]})
    assert [(r.total_count, json.loads(r.record)) for r in rows] == [(100, {"a": 1}), (100, {"a": 2})]
    assert len(unnested(spark, {**meta, "chembl_id_lookups": [], "molecules": [{"b": 1}]})) == 1
    assert len(unnested(spark, {**meta, "molecules": [{"b": 1}]})) == 1
    assert len(unnested(spark, {**meta, "chembl_id_lookups": [{"a": 1}], "molecules": [{"b": 1}, {"b": 2}]})) == 1
    assert unnested(spark, meta) == []
    assert unnested(spark, {**meta, "molecules": "none"}, {**meta, "chembl_id_lookups": [], "molecules": {}}) == []
    assert unnested(spark, "broken", "") == []


# Spark workers do not import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Pages:
    def __init__(self, n, lost=(), make=lambda i: {"i": i}, key="molecules"):
        self.n, self.lost, self.make, self.key = n, lost, make, key

    def total(self):
        return self.n

    def page(self, offset, limit):
        if offset in self.lost:
            raise OSError("gone")
        items = [self.make(i) for i in range(offset, min(self.n, offset + limit))]
        return json.dumps({"page_meta": {"total_count": self.n}, self.key: items})


def test_pages_become_partitions(spark):
    fetched = paged.pages(spark, Pages(2500), name="t_pages")
    assert fetched.rdd.getNumPartitions() == 1
    many = paged.pages(spark, Pages(30_000_000), name="t_many")
    assert many.rdd.getNumPartitions() <= paged.RANGES
    assert sorted(r.page_offset for r in fetched.collect()) == [0, 1000, 2000]
    rows = normalize.unnest_pages(paged.good_pages(fetched))
    assert rows.select(F.get_json_object("record", "$.i").cast("int").alias("i")).agg(F.sum("i"), F.count("i")).first()[:] == (
        sum(range(2500)), 2500,
    )


def test_lost_page_is_reported(spark):
    fetched = paged.pages(spark, Pages(2500, lost={1000}), name="t_lost")
    assert normalize.unnest_pages(paged.good_pages(fetched)).count() == 1500
    assert normalize.page_faults(fetched, 1000).first()[:] == (1000, "lost: OSError: gone", 0)


def test_ranges_of_a_table(spark, tmp_path):
    """Pages that cross row groups and files, a last one that is not full, and
    one past the end."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    for part in range(3):
        pq.write_table(pa.table({"i": range(part * 25, part * 25 + 25)}), tmp_path / f"{part}.parquet", row_group_size=7)
    fetcher = paged.ParquetPages(str(tmp_path), ["i"])
    found = {r.page_offset: [x["i"] for x in json.loads(r.body)["molecules"]] for r in paged.pages(spark, fetcher, 4, "t_ranges").collect()}
    assert found == {at: list(range(at, min(75, at + 4))) for at in range(0, 75, 4)}
    assert json.loads(fetcher.page(73, 4))["molecules"] == [{"i": 73}, {"i": 74}]
    assert json.loads(fetcher.page(75, 4))["molecules"] == []


def test_each_row_group_is_read_once(spark, tmp_path):
    """Pages are cut where a partition ends; none is short then."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"i": range(1000)}), tmp_path / "a.parquet", row_group_size=90)
    pq.write_table(pa.table({"i": range(1000, 1050)}), tmp_path / "b.parquet", row_group_size=9)
    groups = []

    class Counting(paged.ParquetPages):
        def _records(self, own):
            for block in own:
                groups.append((block.file, block.group))
                yield from super()._records([block])

    fetcher = Counting(str(tmp_path), ["i"])
    reader = paged._PageReader(fetcher, 8)
    parts = reader.partitions()
    rows = [row for part in parts for row in reader.read(part)]
    assert len(groups) == len(set(groups)) == len(fetcher.blocks()) == 12 + 6 and len(parts) > 10
    records = [x["i"] for r in sorted(rows) for x in json.loads(r[2])["molecules"]]
    assert records == list(range(1050)) and {r[1] for r in rows} == {"ok"}
    starts = {part.value[1][0].start for part in parts}
    assert {r[0] for r in rows} == set(range(0, 1050, 8)) | starts  # seams beside the even offsets
    assert max(r[4] for r in rows) == 8 and sum(r[4] for r in rows) == 1050

    fetched = paged.pages(spark, paged.ParquetPages(str(tmp_path), ["i"]), 8, "t_seams")
    assert fetched.rdd.getNumPartitions() == len(parts)
    assert normalize.page_faults(fetched, 8).count() == 0
    assert normalize.unnest_pages(paged.good_pages(fetched)).count() == 1050


def test_a_group_that_cannot_be_read_loses_its_pages_only(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"i": range(100)}), tmp_path / "a.parquet", row_group_size=10)

    class Faulty(paged.ParquetPages):
        def _records(self, own):
            for block in own:
                if block.group == 3:
                    raise OSError("torn")
                yield from super()._records([block])

    reader = paged._PageReader(Faulty(str(tmp_path), ["i"]), 10)
    rows = [row for part in reader.partitions() for row in reader.read(part)]
    assert [r[0] for r in rows if r[1] == "lost"] == [30] and len(rows) == 10


def test_every_kind_of_page_fault(spark, tmp_path):
    """One failing, one cut-off and one short page of lookups, and none of
    molecules: the job tells all three and does not match."""

    class Damaged(Pages):
        def page(self, offset, limit):
            text = super().page(offset, limit)
            if offset == 10:
                return text[:-1]
            if offset == 20:
                data = json.loads(text)
                return json.dumps({**data, self.key: data[self.key][:-2]})
            return text

    lookups = Damaged(45, lost={30}, make=lambda i: {**LOOKUP, "chembl_id": f"L{i}"}, key="chembl_id_lookups")
    out = ingest.Staging(str(tmp_path), "7")
    steps = {r.step: r for r in ingest.run(spark, lookups, Pages(0), out, rows=10).collect()}
    faults = {r.page_offset: (r.reason, r.n_records) for r in spark.read.parquet(out.path("page_faults_lookups")).collect()}
    assert faults == {
        10: ("broken: not a JSON object", 0), 20: ("short: 8 of 10 records", 8), 30: ("lost: OSError: gone", 0),
    }
    assert steps["lookup records"][1:] == (45, 23, False)
    assert steps["lookup page faults"][1:] == (0, 3, False)
    assert steps["molecule records"].matches and steps["molecule page faults"].matches


def test_no_records(spark):
    fetched = paged.pages(spark, Pages(0), name="t_none")
    assert normalize.unnest_pages(paged.good_pages(fetched)).count() == 0


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.5, "a"), (float("nan"), "b"), (None, "c")], "x double, k string")
    assert [r.x for r in normalize.nan_to_null(df, ["x"]).collect()] == [1.5, None, None]


def test_http_pages_retry_then_raise(monkeypatch):
    calls = []

    class Answer:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def read(self):
            return b'{"page_meta": {"total_count": 7}}'

    def opened(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("busy")
        return Answer()

    monkeypatch.setattr(paged.urllib.request, "urlopen", opened)
    assert paged.HttpPages("http://host/x.json", wait=0).total() == 7
    assert calls == ["http://host/x.json?limit=1"] * 3
    calls.clear()
    with pytest.raises(OSError):
        paged.HttpPages("http://host/x.json", tries=2, wait=0).page(5, 9)
    assert calls == ["http://host/x.json?limit=9&offset=5"] * 2


def test_ingest_job(spark, tmp_path):
    def molecule(i):
        item = {**MOLECULE, "molecule_chembl_id": f"M{i}", "molecule_structures": {"canonical_smiles": "C" * (i % 30 + 1)}}
        if i % 10 == 3:
            item["molecule_structures"] = None
        if i % 10 == 4:
            item["oral"] = "maybe"
        if i % 10 == 5:
            item["molecule_structures"] = {"canonical_smiles": "C("}
        return item

    lookups = Pages(30, make=lambda i: {**LOOKUP, "chembl_id": f"L{i}"}, key="chembl_id_lookups")
    out = ingest.Staging(str(tmp_path))
    for _ in range(2):  # a repeated run changes nothing
        steps = {r.step: tuple(r)[1:] for r in ingest.run(spark, lookups, Pages(100, make=molecule), out).collect()}
    count = lambda name: spark.read.parquet(out.path(name)).count()
    assert count("staging_chembl_id_lookup") == 30
    assert count("staging_molecule_dictionary") == 90
    assert count("staging_compound_properties") == 90
    assert count("staging_compound_structures") == 80
    assert count("refused_molecules") == 10 and count("refused_lookups") == 0
    assert steps == {
        "lookup records": (30, 30, True), "lookup page faults": (0, 0, True), "molecule records": (100, 100, True),
        "molecule page faults": (0, 0, True), "broken keys": (0, 0, True), "fingerprints": (80, 70, False),
    }
    prints = spark.read.parquet(out.path("fingerprints"))
    assert ingest.require_settings(prints) is prints
    with pytest.raises(ValueError):
        ingest.require_settings(prints, radius=3)
    with pytest.raises(ValueError):
        ingest.require_settings(prints.select(F.col("fingerprint").alias("fingerprint", metadata={})))
    checked = spark.read.parquet(out.path("checked_molecules"))
    plan = normalize.structures_table(checked)._jdf.queryExecution().executedPlan().toString()
    scanned = plan[plan.index("ReadSchema") :]
    assert "structures" in scanned and "dictionary" not in scanned and "properties" not in scanned


def test_fingerprints_are_computed_once(spark, tmp_path):
    """The plan that is written holds the hash of the substrings once."""
    rows = spark.createDataFrame([("a", "CC"), ("b", "C(")], "chembl_id string, canonical_smiles string")
    prints = ingest.fingerprints(rows)
    kept = normalize.only(prints, F.col("fingerprint").isNotNull())
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    ingest.write_fingerprints(prints, str(tmp_path / "p"))
    found = spark.read.parquet(str(tmp_path / "p")).select("chembl_id", "words", pack(F.col("fingerprint")).alias("same")).collect()
    assert [(r.chembl_id, r.words == r.same) for r in found] == [("a", True)]


def test_batch_fingerprint_function(spark):
    rows = spark.createDataFrame([("a", "CC"), ("b", "")], "chembl_id string, canonical_smiles string")

    def own(texts, radius, n_bits):
        return texts.map(lambda t: ("1" if t else None) and format(len(t), "b").zfill(n_bits))

    found = ingest.batch_fingerprints(rows, own, n_bits=8).orderBy("chembl_id").collect()
    assert [tuple(r) for r in found] == [("a", "00000010"), ("b", None)]
