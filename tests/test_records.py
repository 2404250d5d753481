"""CSV records with quoted line breaks from files that are cut anywhere."""

import csv
import io
import random

import pytest

from railtide.plans import ridership
from railtide.sinks import tables
from railtide.sources import files

from pyspark.sql import functions as F


def plain(text):
    """Rows of a headerless file by the standard reader, line by line; blank cells are None."""
    rows = list(csv.reader(io.StringIO(text, newline="")))
    return [[c.replace("\r\n", "\n") if c.strip(" ") else None for c in row] or [None] for row in rows]


def written(rng, rows):
    def cell():
        kind = rng.randrange(7)
        word = "".join(rng.choice('ab ,"\n') for _ in range(rng.randrange(9)))
        if kind < 3:
            return '"' + word.replace('"', '""') + '"'
        if kind == 3:
            return 'x' + word.replace(",", "").replace("\n", "")
        return ["", "plain", '"" tail', '"q"z'][kind - 3]

    return "".join(",".join(cell() for _ in range(rng.randrange(1, 5))) + "\n" for _ in range(rows))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("split", [40, 300, 10 ** 6])
def test_records_equal_the_standard_reader(spark, tmp_path, seed, split):
    rng = random.Random(seed)
    texts = {f"b{i}.csv": written(rng, 60) for i in range(3)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = files.read_grid(spark, str(tmp_path)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for name, text in texts.items():
        rows = sorted((r.row_idx, r.cells) for r in got if r.file.endswith(name))
        assert [i for i, _ in rows] == list(range(len(rows)))
        assert [c for _, c in rows] == plain(text)


def test_torn_header_cells(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes(b'Station,"Recto\r\nmain"\r\n,"x\r\n')
    rows = sorted((r.row_idx, r.cells) for r in files.read_grid(spark, str(tmp_path)).collect())
    assert rows == [(0, ["Station", "Recto\nmain"]), (1, [None, "x"])]


SHEET = "Counts 7-9am (AM Peak)\nStation,,Recto,\nDate,Day,Entry,Exit\n1-Jan,Sun,10,20\n"


def test_an_unreadable_sheet_is_a_problem_of_its_year(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "AFCS_jan_2023.csv").write_text(SHEET)
    (tmp_path / "in" / "AFCS_jan_2024.csv").write_text(SHEET)
    (tmp_path / "in" / "AFCS_feb_2024.xlsx").write_bytes(b"no workbook")
    (tmp_path / "in" / "~$AFCS_mar_2023.xlsx").write_bytes(b"lock")
    (tmp_path / "in" / "AFCS_feb_2025.xlsx").write_bytes(b"no workbook")
    now = F.lit("2026-06-18 10:00:00").cast("timestamp")
    out = ridership.load_ridership(spark, str(tmp_path / "in"), str(tmp_path / "m"), str(tmp_path / "b"), now)
    status = {r.year: (r.accepted, r.files, r.problems) for r in out.status.collect()}
    assert status == {2023: (True, 1, 0), 2024: (False, 2, 1), 2025: (False, 1, 1)}
    stored = tables.read_table(spark, str(tmp_path / "m"))
    assert {r[0] for r in stored.select(F.year("date")).distinct().collect()} == {2023}
