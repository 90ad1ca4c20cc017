import datetime as dt

from pyspark.sql import functions as F

from simmart.functions.text import count_text, decode_bytes, month_prefix, strip
from simmart.operators.targets import molecules, monthly_targets, refused_lines
from simmart.sources import files

DAY = dt.date(2024, 8, 1)

# The known lines and what becomes of them.
CONTENT = """chembl_id,smiles
    CHEMBL1,C
    CHEMBL2,CC, extra comma
    CHEMBL3,C#C 
    CHEMBL4,
    CHEMBL5,CC(C)C(C)CαC
   \t
abc
CHEMBL6,CC,
"""


def write(folder, name, data):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data if isinstance(data, bytes) else data.encode())


def lines_both_ways(spark, folder, day=DAY):
    yield files.text_lines(files.target_files(spark, str(folder), day))
    yield files.target_file_lines(spark, str(folder), day)


def test_clean_rules(spark, tmp_path):
    write(tmp_path / "in", "data_08_2024.csv", CONTENT)
    for lines in lines_both_ways(spark, tmp_path / "in"):
        kept = [(r.chembl_id, r.smiles) for r in molecules(lines).orderBy("line").collect()]
        # The trailing comma of CHEMBL6 is a further comma, too.
        assert kept == [("CHEMBL1", "C"), ("CHEMBL3", "C#C"), ("CHEMBL4", "")]
        refused = [(r.line, r.reason) for r in refused_lines(lines).orderBy("line").collect()]
        assert refused == [(3, "extra comma"), (6, "non-ascii"), (8, "malformed"), (9, "extra comma")]


def test_first_of_each_id_in_file_then_line_order(spark, tmp_path):
    rows = "h\nA,1\nB,2\nA,3\n"
    write(tmp_path / "in", "data_08_2024_1.csv", rows)
    write(tmp_path / "in", "data_08_2024_2.csv", "h\nB,9\nC,4\nA,9\n")
    for lines in lines_both_ways(spark, tmp_path / "in"):
        found = {(r.chembl_id, r.smiles) for r in monthly_targets(lines).collect()}
        assert found == {("A", "1"), ("B", "2"), ("C", "4")}


def test_two_equal_files_give_each_molecule_once(spark, tmp_path):
    text = "id,structure\n M1,NCCN\n M2,CSC\n M3,C1CC1\n "
    write(tmp_path / "in", "data_08_2024_1.csv", text)
    write(tmp_path / "in", "data_08_2024_2.csv", text)
    for lines in lines_both_ways(spark, tmp_path / "in"):
        found = {(r.chembl_id, r.smiles) for r in monthly_targets(lines).collect()}
        assert found == {("M1", "NCCN"), ("M2", "CSC"), ("M3", "C1CC1")}


def test_latin_1_file(spark, tmp_path):
    write(tmp_path / "in", "data_08_2024.csv", "h\nA,C\nB,é\nC,N\r\n".encode("latin-1"))
    for lines in lines_both_ways(spark, tmp_path / "in"):
        assert [r.content for r in lines.where("line = 3").collect()] == ["B,é"]
        found = {(r.chembl_id, r.smiles) for r in molecules(lines).collect()}
        assert found == {("A", "C"), ("C", "N")}


def test_only_the_months_files(spark, tmp_path):
    write(tmp_path / "in", "data_08_2024_x.csv", "h\nA,C\n")
    write(tmp_path / "in", "data_07_2024.csv", "h\nB,C\n")
    write(tmp_path / "in", "other_08_2024.csv", "h\nC,C\n")
    for lines in lines_both_ways(spark, tmp_path / "in"):
        assert [r.chembl_id for r in molecules(lines).collect()] == ["A"]


def test_blank_and_missing_files(spark, tmp_path):
    write(tmp_path / "in", "data_08_2024.csv", " \n\t\n")
    assert files.target_files(spark, str(tmp_path / "in"), DAY).count() == 0
    for lines in lines_both_ways(spark, tmp_path / "in"):
        assert molecules(lines).count() == 0
    for lines in lines_both_ways(spark, tmp_path / "in", dt.date(2030, 1, 1)):
        empty = monthly_targets(lines)
        assert empty.count() == 0 and empty.columns == ["chembl_id", "smiles"]


def test_lines_are_numbered_across_splits(spark, tmp_path):
    """A file cut into many splits numbers its lines as a whole."""
    text = "\n".join(["h"] + [f"M{i},{'C' * (i % 17)}" for i in range(2000)])
    write(tmp_path / "in", "data_08_2024_big.csv", text)
    write(tmp_path / "in", "data_08_2024_a.csv", "h\nZ,1\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        lines = files.target_file_lines(spark, str(tmp_path / "in"), DAY).where("file like '%big%'")
        assert files.target_file_lines(spark, str(tmp_path / "in"), DAY).rdd.getNumPartitions() >= 1
        got = [(r.line, r.content) for r in lines.orderBy("line").collect()]
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert got == list(enumerate(text.split("\n"), start=1))


def test_strip_is_python_strip(spark):
    texts = ["  a b \x1c", "　x ", "\x0b\x85", "", "​z", "q\r\n\t "]
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r.y for r in rows.select(strip(F.col("x")).alias("y")).collect()] == [t.strip() for t in texts]


def test_decode(spark):
    rows = spark.createDataFrame([(b"a\xc3\xa9",), (b"a\xe9",), (b"",)], "x binary")
    assert [r.y for r in rows.select(decode_bytes(F.col("x")).alias("y")).collect()] == ["aé", "aé", ""]


def test_count_text_and_month(spark):
    rows = spark.createDataFrame([(3.0,), (2.5,), (None,), (0.0,), (-1.0,)], "x double")
    assert [r.y for r in rows.select(count_text(F.col("x")).alias("y")).collect()] == ["3", "2.5", None, "0", "-1"]
    day = spark.createDataFrame([(DAY,)], "d date").select(month_prefix(F.col("d")).alias("p"))
    assert day.first()["p"] == "data_08_2024" and files.month_glob(DAY) == "data_08_2024*"
