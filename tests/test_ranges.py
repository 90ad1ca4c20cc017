import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from simmart.sources import ranges


def spread(spark, values, splits):
    """Ranges of a table with these ids, and the rows that each gives."""
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "id bigint, row int").repartition(5)
    cut = ranges.quantile_ranges(df, "id", splits)
    found = ranges.read_ranges(df, "id", cut, "split").collect()
    assert sorted(r.row for r in found) == list(range(len(values)))  # every row once
    sizes = [0] * len(cut)
    for r in found:
        sizes[r.split] += 1
    return cut, sizes


@pytest.mark.parametrize("splits", [1, 4, 30])
def test_skewed_ids_give_even_ranges(spark, splits):
    """Even steps would put nearly all rows into one range."""
    rng = random.Random(3)
    ids = sorted({int(10 ** (rng.random() * 15)) for _ in range(6000)} | {-(10**17)})
    cut, sizes = spread(spark, ids, splits)
    assert len(cut) == splits and max(sizes) <= 1.5 * len(ids) / splits


def test_repeated_nulls_and_few_ids(spark):
    """A third of the rows have one id, which gets a range of its own."""
    ids = [500] * 1000 + list(range(2000)) + [None] * 40
    cut, sizes = spread(spark, ids, 10)
    hot = cut.index(ranges.KeyRange(500, True, 500, True))
    assert sizes[hot] == 1001 and max(sizes[:hot] + sizes[hot + 1 :]) <= 1.5 * 304
    for few in ([], [None], [7], [7, 7, 7], [1, 2, 2**62], [5] * 50 + [6] * 50):
        spread(spark, few, 4)
    with pytest.raises(ValueError, match="not a whole number"):
        ranges.quantile_ranges(spark.range(3).select(F.col("id").cast("string").alias("id")), "id", 2)


@pytest.fixture
def molecules(tmp_path):
    path = str(tmp_path / "molecules.db")
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE molecules (id INTEGER, smiles TEXT)")
    rows = [(i**5, "C" * (i % 9) or None) for i in range(-20, 400)]
    db.executemany("INSERT INTO molecules VALUES (?, ?)", rows)
    db.commit()
    db.close()
    return path, rows


def test_keyset_pages_of_planned_ranges(spark, molecules):
    path, rows = molecules

    def connect():
        import sqlite3

        return sqlite3.connect(path)

    schema = "id bigint, smiles string"
    found = ranges.planned_keyset_table(spark, connect, "molecules", schema, "id", 6, chunk=17, name="t_keyset")
    assert sorted((r.id, r.smiles) for r in found.collect()) == sorted(rows)
    sizes = [len(p) for p in found.rdd.glom().collect()]
    assert len(sizes) == 6 and max(sizes) <= 1.5 * len(rows) / 6
    db = sqlite3.connect(path)
    db.execute("DELETE FROM molecules")
    db.commit()
    assert ranges.planned_keyset_table(spark, connect, "molecules", schema, "id", 6, name="t_empty").count() == 0


def reader(connect, chunk, tries=3):
    return ranges._KeysetReader(connect, "molecules", ["smiles", "id"], "id", [ranges.KeyRange(None, False, None, False)], chunk, tries, 0)


@pytest.mark.parametrize("chunk", [1, 3, 420, 421, 1000])
def test_a_lost_connection_goes_on_after_the_last_key(molecules, chunk):
    path, rows = molecules
    asked = []

    class Shaky:
        def __init__(self):
            self.db = sqlite3.connect(path)

        def cursor(self):
            return self

        def execute(self, text):
            asked.append(text)
            if len(asked) % 3 == 2:
                raise OSError("gone")
            self.found = self.db.execute(text)

        def fetchall(self):
            return self.found.fetchall()

        def close(self):
            self.db.close()

    part, = reader(Shaky, chunk).partitions()
    assert [(i, s) for s, i in reader(Shaky, chunk).read(part)] == rows
    assert all(f"LIMIT {chunk + 1}" in text and "OFFSET" not in text for text in asked)

    def dead():
        raise OSError("down")

    with pytest.raises(OSError):
        list(reader(dead, chunk).read(part))


def test_a_key_that_repeats_is_told(molecules):
    path, rows = molecules
    db = sqlite3.connect(path)
    for key in (rows[2][0], None):
        db.execute("INSERT INTO molecules VALUES (?, 'again')", (key,))
        db.commit()
        for chunk in (1, 3, 1000):
            r = reader(lambda: sqlite3.connect(path), chunk)
            part = ranges._Range("1 = 1")
            with pytest.raises(ValueError, match="repeats"):
                list(r.read(part))
        db.execute("DELETE FROM molecules WHERE smiles = 'again'")
