"""End-to-end jobs on small invented inputs."""

import json

import pytest
from pyspark.sql import functions as F

from railtide import vocab
from railtide.operators import nested
from railtide.plans import calendars, posts, repair, ridership, weather, workbooks
from railtide.sinks import tables
from railtide.sources import feeds, files, state

NOW = "2026-06-18 12:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


DAILY = """Ridership,,,,,
7-9am (AM Peak),,,,,
,,,,,
Station,,Recto,,Betty Go,
Date,Day,Entry,Exit,Entry,Exit
1-Jan,Mon,"1,200",900,-,30
2-Jan,Tue,1300,950,25,
5-7pm (PM Peak),,,,,
Station,,Recto,,Betty Go,
Date,Day,Entry,Exit,Entry,Exit
1-Jan,Mon,100,90,5,7
not a date,,1,1,1,1
2-Jan,Tue,10,,,
"""
MONTHLY = """Summary,,,,
Station,Recto,,Total,
Time,Entry,Exit,Entry,Exit
07:00-08:00,"1,000",2,3,4
08:00-09:00,5,6,7,8
,,,,
Peak Hours,Recto,,Total,
Subtotal (Peak),11,12,13,14
Total,15,16,17,18
"""


def write_sheets(folder, sheets):
    folder.mkdir(exist_ok=True)
    for name, content in sheets.items():
        (folder / name).write_text(content)
    return str(folder)


def test_daily_sheet(spark, tmp_path):
    folder = write_sheets(tmp_path / "raw", {"AFCS January 2023.csv": DAILY, "~$AFCS January 2023.csv": "x", "other January 2023.csv": DAILY})
    out = ridership.load_ridership(spark, folder, str(tmp_path / "main"), str(tmp_path / "backup"), now())
    rows = {(str(r.date), r.time_period): r for r in out.wide.collect()}
    assert set(rows) == {(f"2023-01-0{d}", p) for d in (1, 2) for p in (vocab.DAILY_TOTAL, vocab.AM_PEAK, vocab.PM_PEAK)}
    assert out.wide.columns[4:] == ["betty_go_belmonte_entry", "betty_go_belmonte_exit", "recto_entry", "recto_exit"]
    total = rows["2023-01-01", vocab.DAILY_TOTAL]
    assert (total.recto_entry, total.recto_exit, total.betty_go_belmonte_entry, total.betty_go_belmonte_exit) == (1300, 990, 5, 37)
    assert rows["2023-01-01", vocab.AM_PEAK].betty_go_belmonte_entry is None
    assert rows["2023-01-02", vocab.DAILY_TOTAL].betty_go_belmonte_exit is None
    order = [(r.time_period, str(r.date)) for r in out.wide.orderBy("id").collect()]
    assert order == [(p, f"2023-01-0{d}") for p in (vocab.DAILY_TOTAL, vocab.AM_PEAK, vocab.PM_PEAK) for d in (1, 2)]
    assert out.wide.orderBy("id").first().id == "YR2023-0001"
    assert tables.read_table(spark, str(tmp_path / "main")).count() == tables.read_table(spark, str(tmp_path / "backup")).count() == 6

    # a second load of the same sheet only touches, a new station adds columns
    later = F.lit("2026-07-01 00:00:00").cast("timestamp")
    ridership.load_ridership(spark, folder, str(tmp_path / "main"), str(tmp_path / "backup"), later)
    stored = tables.read_table(spark, str(tmp_path / "main"))
    assert stored.count() == 6 and [str(r[0]) for r in stored.select("load_timestamp").distinct().collect()] == ["2026-07-01 00:00:00"]
    more = write_sheets(tmp_path / "feb", {"afcs_feb_2023.csv": DAILY.replace("-Jan", "-Feb").replace("Recto", "Legarda")})
    ridership.load_ridership(spark, more, str(tmp_path / "main"), str(tmp_path / "backup"), later)
    stored = tables.read_table(spark, str(tmp_path / "main"))
    assert stored.count() == 12 and {"recto_entry", "legarda_entry"} <= set(stored.columns)


def test_reference_mode_loses_later_files(spark, tmp_path):
    main, backup = str(tmp_path / "m"), str(tmp_path / "b")
    jan = write_sheets(tmp_path / "jan", {"afcs_jan_2023.csv": DAILY})
    feb = write_sheets(tmp_path / "feb", {"afcs_feb_2023.csv": DAILY.replace("-Jan", "-Feb")})
    for folder in (jan, feb):
        ridership.load_ridership(spark, folder, main, backup, now(), mode="reference")
    stored = tables.read_table(spark, main)
    assert stored.count() == 6 and stored.where(F.month("date") == 2).count() == 0


def test_monthly_sheet(spark, tmp_path):
    folder = write_sheets(tmp_path / "raw", {"AFCS_march_2024.csv": MONTHLY})
    out = ridership.parse_ridership(files.read_grid(spark, folder))
    rows = {r.time_period: r for r in out.wide.collect()}
    assert set(rows) == {"07:00-08:00", "08:00-09:00", vocab.PEAK_TOTAL, vocab.MONTHLY_TOTAL}
    assert {str(r.date) for r in rows.values()} == {"2024-03-01"}
    assert (rows["07:00-08:00"].recto_entry, rows["07:00-08:00"].total_exit) == (1000, 4)
    assert (rows[vocab.MONTHLY_TOTAL].recto_exit, rows[vocab.MONTHLY_TOTAL].total_entry) == (16, 17)
    assert out.wide.columns[-2:] == ["total_entry", "total_exit"]


def test_a_bad_year_is_left_out_whole(spark, tmp_path):
    folder = write_sheets(tmp_path / "raw", {
        "AFCS_jan_2023.csv": DAILY, "AFCS_feb_2023.csv": DAILY.replace("950", "-950").replace("-Jan", "-Feb"),
        "AFCS_jan_2024.csv": DAILY, "AFCS_jan_2025.csv": DAILY.replace("7-9am (AM Peak)", "x"), "AFCS_may_2026.csv": "a,b\n1,2\n",
    })
    out = ridership.parse_ridership(files.read_grid(spark, folder))
    status = {r.year: (r.accepted, r.kinds) for r in out.status.collect()}
    assert status == {2023: (False, ["negative"]), 2024: (True, None), 2025: (False, ["no_period"]), 2026: (False, ["no_rows"])}
    assert {r.id[:6] for r in out.wide.collect()} == {"YR2024"}
    lenient = ridership.parse_ridership(files.read_grid(spark, folder), strict=False)
    assert lenient.wide.where("year = 2023").count() == 12


def test_rows_keep_their_place_in_split_files(spark, tmp_path):
    lines = [f"{i},x" for i in range(20_000)]
    folder = write_sheets(tmp_path / "raw", {"AFCS_jan_2023.csv": "\n".join(lines) + "\n", "b.csv": "0,y\n1,z\n"})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        grid = files.read_grid(spark, folder)
        assert grid.count() == 20_002
        assert grid.where(F.col("row_idx") != F.get("cells", F.lit(0)).cast("int")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_file_choice(spark, tmp_path):
    for sub in ("z/External", "a/b/Internal/deep", "Internal"):
        (tmp_path / sub).mkdir(parents=True)
        (tmp_path / sub / "Students.csv").write_text("x\n")
    (tmp_path / "Internal" / "~$Students.csv").write_text("x\n")
    (tmp_path / "AFCS Feb 2023.csv").write_text("x\n")
    (tmp_path / "afcs jan 2023.xlsx").write_text("x\n")
    listed = files.list_files(spark, str(tmp_path))
    assert "/" + "/".join(files.pending_file(listed, "students.CSV", "external").first().path.split("/")[-3:]) == "/z/External/Students.csv"
    assert files.pending_file(listed, "students.csv", "internal").first().path.endswith(f"{tmp_path.name}/Internal/Students.csv")
    assert [(r.year, r.month) for r in files.discover_sheets(spark, str(tmp_path)).collect()] == [(2023, 1), (2023, 2)]


def test_workbooks(spark, tmp_path):
    sheets = tmp_path / "w"
    write_sheets(sheets, {
        "cap.csv": ",".join(workbooks.REQUIRED["capacity"]) + '\nRecto,Island,120.5,900,1500,2400\n,,,,,\nLegarda,Side,,"1,000",,\n',
        "inc.csv": "Category,Specific Incident / Transgression\nSafety,Falling\nSecurity,\n",
        "students.csv": 'Month,2023,2024\nJanuary,"1,000",5\nFebruary,,6\nTOTAL,1000,11\n',
        "f1.csv": ",".join(workbooks.REQUIRED["friction"]) + "\nStrike,Tigil,src,http://x,0.9\nExam,Week,src,http://y,0.2\n",
        "f2.csv": ",".join(workbooks.REQUIRED["friction"]) + "\nRain,Red,src,http://z,1.0\n",
    })
    got = workbooks.load_workbook(spark, "capacity", str(sheets / "cap.csv"), str(tmp_path / "cap"), now())
    assert [(r.id, r.station_name, r.directional_platform_limit_pax) for r in got.orderBy("id").collect()] == [("CAP-0001", "Recto", 900), ("CAP-0002", "Legarda", None)]
    assert workbooks.load_workbook(spark, "capacity", str(sheets / "cap.csv"), str(tmp_path / "cap"), now()).count() == 0
    with pytest.raises(workbooks.RejectedFile):
        workbooks.read_workbook(spark, "incidents", str(sheets / "inc.csv"))
    assert [r.id for r in workbooks.read_workbook(spark, "incidents", str(sheets / "inc.csv"), strict=False).collect()] == ["PSOR-0001"]
    with pytest.raises(ValueError, match="lacks"):
        workbooks.read_workbook(spark, "protocols", str(sheets / "inc.csv"))
    students = workbooks.read_workbook(spark, "students", str(sheets / "students.csv")).collect()
    assert {r.id: r.student_transactions for r in students} == {
        "STU2023-0001": 1000, "STU2023-TOTAL": 1000, "STU2024-0001": 5, "STU2024-0002": 6, "STU2024-TOTAL": 11}
    friction = workbooks.read_workbook(spark, "friction", {"operational": str(sheets / "f1.csv"), "pagasa": str(sheets / "f2.csv"), "academic": None})
    assert sorted((r.id, r.friction_weight) for r in friction.collect()) == [
        ("FRI-OPERATIONAL-0001", 0.9), ("FRI-OPERATIONAL-0002", 0.2), ("FRI-PAGASA-0001", 1.0)]


PAGES = [
    {"batch": "East", "station": "Recto", "name": "North University", "source_type": "academic", "tier": "major", "url": "https://www.facebook.com/NorthU/"},
    {"batch": "West", "station": "Cubao", "name": "River City Government", "source_type": "lgu", "tier": "lgu", "url": "https://www.facebook.com/RiverCity"},
    {"batch": "West", "station": "Antipolo", "name": "Fatima School", "source_type": None, "tier": "quiet", "url": "https://www.facebook.com/fatima.school"},
]


def item(page, n, text, age_hours=1, **more):
    base = PAGES[page]["url"].rstrip("/")
    made = {"inputUrl": base, "url": f"{base}/posts/{n}", "text": text, "time": f"2026-06-18T{12 - age_hours:02d}:00:00.000Z"}
    return {**made, **more}


@pytest.fixture
def feed(spark, tmp_path):
    (tmp_path / "pages.json").write_text(json.dumps(PAGES))

    def load(items):
        path = tmp_path / f"items{len(list(tmp_path.iterdir()))}.json"
        path.write_text("\n".join(json.dumps({**i, "item_seq": n}) for n, i in enumerate(items)))
        raw = spark.read.schema(feeds.ITEM_SCHEMA + ", item_seq bigint").json(str(path))
        return feeds.post_items(raw), feeds.read_pages(spark, str(tmp_path / "pages.json"))

    return load


def test_posts_job(spark, feed):
    items, pages = feed([
        item(0, 1, "Walang pasok bukas, no classes in all levels"),
        item(0, 2, "WALANG  PASOK bukas, no classes in all levels"),
        item(0, 3, "Happy birthday to our dean"),
        item(1, 4, "Transport strike on 2026-06-20, stay safe"),
        item(1, 5, "Transport strike of 2020-01-01 remembered"),
        item(1, 6, "Heavy rain warning for the city", age_hours=11),
        item(2, 7, "No classes in laguna"),
        item(2, 8, "No classes in all campuses (except laguna)"),
        item(1, 9, "Flash flood along the river", url="https://www.facebook.com/people/x/posts/9"),
        {"inputUrl": "https://elsewhere.org", "url": "https://www.facebook.com/x/posts/10", "text": "No classes"},
        item(1, 11, "", media=[{"thumbnail": "http://img/1", "ocrText": "ADVISORY\nNumber coding suspended\n#river"}]),
    ])
    run = posts.run_posts(items, pages, None, now())
    got = {r.source_url.rsplit("/", 1)[1]: r for r in run.events.collect()}
    assert set(got) == {"1", "4", "8", "11"}
    assert (got["1"].category, got["1"].event_code, got["1"].id) == ("academic", "CLASS_SUSPENSION", "external_acad_0001")
    assert (got["4"].category, got["4"].event_code, got["4"].event_date) == ("lgu", "TRANSPORT_STRIKE", "2026-06-20")
    assert got["8"].category == "academic" and got["8"].id == "external_acad_0002"
    assert got["11"].post_text == vocab.PLACEHOLDER_CAPTION and got["11"].image_text == "ADVISORY Number coding suspended"
    assert str(got["1"].post_date) == "2026-06-18 11:00:00"
    assert {r.stage: r.rows for r in run.summary.collect()}["saved"] == 4

    # everything is stored now: the same sweep finds nothing, a new post gets the next number
    assert posts.run_posts(items, pages, run.events, now()).events.count() == 0
    more, _ = feed([item(0, 20, "Enrollment moved: campus closed on Friday"), item(0, 21, "walang pasok bukas, NO CLASSES in all levels")])
    again = posts.run_posts(more, pages, run.events, now()).events.collect()
    assert [(r.id, r.source_url.rsplit("/", 1)[1]) for r in again] == [("external_acad_0003", "20")]
    assert posts.run_posts(items, pages, None, now(), batch="east").events.count() == 1


def test_posts_are_ranked_without_their_texts(spark, feed):
    items, pages = feed([item(n % 3, n, f"text {n}") for n in range(9)])
    paged = posts.page_posts(items, pages, "strong", now())
    lines = paged._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    ranks = [n for n, line in enumerate(lines) if "Window [row_number" in line and "posted_at" in line]
    assert ranks
    for n in ranks:
        end = next((m for m in range(n + 1, len(lines)) if depth[m] <= depth[n]), len(lines))
        below = "\n".join(lines[n:end])
        assert "raw_text" not in below
    assert sorted((r.item_seq, r.text, r.source_name) for r in paged.collect()) == [
        (n, f"text {n}", PAGES[n % 3]["name"]) for n in range(9)]


def test_posts_job_that_stores(spark, feed, tmp_path):
    path = str(tmp_path / "events")
    items, pages = feed([item(0, 1, "Walang pasok bukas, no classes in all levels", age_hours=5), item(1, 4, "Transport strike on 2026-06-20, stay safe")])
    run = posts.store_posts(items, pages, path, now())
    assert {r.url.rsplit("/", 1)[1] for r in run.digest.collect()} == {"1", "4"}
    assert sum(r.new_events for r in run.counts.collect()) == tables.read_table(spark, path).count() == 2
    again = posts.store_posts(items, pages, path, now())
    assert again.digest.count() == again.counts.count() == 0 and tables.read_table(spark, path).count() == 2

    more, _ = feed([item(0, 9, "Class suspension lifted, classes resume tomorrow in all levels", age_hours=1)])
    assert posts.store_posts(more, pages, path, now()).events.count() == 1
    got = {r.source_url.rsplit("/", 1)[1]: (r.id, r.is_cancellation, r.is_active) for r in posts.active_events(spark, path).collect()}
    assert got["1"] == ("external_acad_0001", False, False)
    assert got["9"] == ("external_acad_0002", True, True) and got["4"][1:] == (False, True)


def test_long_names_and_several_dates(spark, feed):
    """An event's key is that of its stored, cut name; the latest real date of the whole text counts."""
    long = "Transport strike " + "and more of it " * 60
    items, pages = feed([
        item(1, 1, long), item(1, 2, "Transport strike of 2020-01-01 returns on 2026-06-20, not on 2026-99-99"), item(1, 3, "Transport strike from 2020-01-01 to 2020-02-01"),
    ])
    run = posts.run_posts(items, pages, None, now())
    got = {r.source_url.rsplit("/", 1)[1]: r for r in run.events.collect()}
    assert set(got) == {"1", "2"} and got["2"].event_date == "2026-06-20"
    assert len(got["1"].event_name) == vocab.EVENT_NAME_CHARS
    # another address and another end of the text, but the same event by its stored name
    more, _ = feed([item(1, 7, long + " until further notice")])
    assert posts.run_posts(more, pages, run.events.withColumns({"post_text": F.lit("edited"), "source_url": F.lit("")}), now()).events.count() == 0


def test_classifier_hook(spark, feed):
    items, pages = feed([
        item(0, 1, "No classes on Monday"), item(0, 2, "Exam week at campus"), item(1, 3, "State of calamity declared"), item(1, 4, "Concert tonight"),
        item(0, 5, "Midterms for every student"),
    ])
    asked = []

    def ask(inputs):
        asked.append(inputs.count())
        answer = (
            F.when(F.col("text").contains("Monday"), F.lit('{"category": "academic", "event_name": "Class suspension", "event_date": "N/A", "event_code": "null"}'))
            .when(F.col("text").contains("calamity"), F.lit('{"category": "weird"}'))
            .when(F.col("text").contains("Midterms"), F.lit('{"category": "academic_calendar", "event_name": "Calendar"}'))
        )
        return inputs.select("key", answer.alias("answer"))

    run = posts.run_posts(items, pages, None, now(), mode="strong", classify=lambda p: posts.classify_once(p, ask))
    got = {r.source_url.rsplit("/", 1)[1]: r for r in run.events.collect()}
    assert asked == [5] and set(got) == {"1", "2", "4", "5"}
    assert (got["1"].event_name, got["1"].event_date, got["1"].event_code) == ("Class suspension", None, None)
    assert (got["2"].event_name, got["2"].event_date) == ("[Fallback] Event detected via keywords (academic)", "Not specified")
    assert got["4"].category == "lgu" and got["5"].category == "academic_calendar"


def test_extractor_budget(spark, feed):
    media = [{"photo_image": {"uri": f"http://img/{i}"}} for i in range(4)]
    items, pages = feed([item(1, 1, "Road closure", media=media), item(1, 2, "Road closed", media=media[:2])])
    placed = items.withColumn("page_seq", F.lit(1))

    def extract(uris):
        return uris.withColumn("extracted", F.concat(F.lit("text "), F.substring_index("uri", "/", -1)))

    got = posts.read_images(placed, "page_seq", ["page_seq", "item_seq"], extract, budget=5).orderBy("item_seq").collect()
    assert [r.image_text for r in got] == ["text 0 text 1 text 2 text 3", "text 0"]


def test_calendar_job(spark, feed, tmp_path):
    items, pages = feed([
        item(0, 1, "The official Academic Calendar for A.Y. 2026-2027 is out now"), item(0, 2, "Draft academic calendar AY 2026-2027, view here"),
        item(0, 3, "Our academic calendar", media=[{"thumbnail": "http://img/cal"}]), item(1, 4, "School calendar AY 2026-2027 released"),
        item(2, 5, "School calendar AY 2026-2027 released for laguna"),
    ])

    def extract(uris):
        return uris.withColumn("extracted", F.lit("A.Y. 2026-2027 released"))

    stored = spark.createDataFrame([("external_acad_cal_0007",)], "id string")
    rows = calendars.find_calendars(items, pages, None, stored, now(), extract)
    got = rows.orderBy("id").collect()
    assert [(r.id, r.source_url.rsplit("/", 1)[1]) for r in got] == [("external_acad_cal_0008", "1"), ("external_acad_cal_0009", "3")]
    assert got[0].event_name == "Academic Calendar A.Y. 2026-2027 — NU" and got[1].image_text == "A.Y. 2026-2027 released"
    ledger = str(tmp_path / "ledger")
    assert state.read_ledger(spark, ledger).count() == 0
    tables.append_ledger(rows.select(F.col("source_url").alias("url")), ledger)
    assert calendars.find_calendars(items, pages, state.read_ledger(spark, ledger), stored, now(), extract).count() == 0
    tables.export_calendars(rows.drop("event_date"), str(tmp_path / "out"))
    exported = spark.read.csv(str(tmp_path / "out"), header=True)
    assert set(exported.columns) == {*vocab.CALENDAR_COLUMNS, "acronym"} and [r.acronym for r in exported.collect()] == ["NU", "NU"]


def test_calendar_job_that_stores(spark, feed, tmp_path):
    text = "The official Academic Calendar for A.Y. 2026-2027 is out now"
    items, pages = feed([item(0, 1, text), item(0, 2, "Good morning"), item(0, 1, text)])
    paths = [str(tmp_path / n) for n in ("events", "ledger", "out")]

    def run(items):
        return sorted(r.id for r in calendars.store_calendars(items, pages, *paths, now()).collect())

    assert run(items) == ["external_acad_cal_0001"] and run(items) == []
    more, _ = feed([item(0, 1, text), item(0, 3, text)])
    # a run that broke off after the upsert is completed by the next one, under the same id
    stored = tables.read_table(spark, paths[0])
    tables.load_upsert(calendars.find_calendars(more, pages, state.read_ledger(spark, paths[1]), stored, now()), paths[0], ["id"])
    assert run(more) == ["external_acad_cal_0002"] and run(more) == []
    assert [r.id for r in spark.read.csv(paths[2], header=True).orderBy("id").collect()] == ["external_acad_cal_0001", "external_acad_cal_0002"]
    assert state.read_ledger(spark, paths[1]).count() == tables.read_table(spark, paths[0]).count() == 2
    assert run(items.where("false")) == []


def primary(temperature, rain, days=3):
    return json.dumps({
        "current": {"time": "2026-06-18T19:45", "temperature_2m": temperature, "relative_humidity_2m": 80, "precipitation": rain, "wind_speed_10m": 5},
        "daily": {"time": [f"2026-06-{18 + i}" for i in range(days)], "temperature_2m_max": [30.0 + i for i in range(days)], "temperature_2m_min": [25.0] * days,
                  "precipitation_sum": [0.0, 8.0, 31.0][:days], "relative_humidity_2m_mean": [70] * days, "wind_speed_10m_max": [9] * days}})


SECONDARY = json.dumps({
    "current_condition": [{"temp_C": "27", "humidity": "66", "precipMM": "16.0", "windspeedKmph": "12"}],
    "weather": [{"date": f"2026-06-{18 + i}", "maxtempC": "33", "mintempC": "24", "hourly": [{"precipMM": "7.5"}, {"precipMM": "99"}]} for i in range(3)]})


def test_weather_jobs(spark, tmp_path):
    stations = spark.createDataFrame([("A", "AA", 0), ("B", "BB", 1), ("C", "CC", 2), ("D", "DD", 3)], "station string, code string, station_seq bigint")
    current = spark.createDataFrame(
        [("A", 20.0, None, 1.0, 2.0, "2026-06-18T10:00:00+00:00", None), ("B", 20.0, 50.0, 1.0, 2.0, None, "2026-06-18T11:30:00+00:00"), ("C", 1.0, 1.0, 1.0, 1.0, "junk", None)],
        "station string, temperature double, humidity double, rainfall_mm double, wind_speed double, fetched_at string, observed_at string")
    payloads = spark.createDataFrame([("A", None, "bad"), ("B", primary(31.5, 40.0), None), ("C", "{", None), ("D", None, SECONDARY)], "station string, primary string, secondary string")
    rows, forecasts = weather.refresh(stations, payloads, current, now())
    got = {r.station: r for r in rows.collect()}
    assert [got[s].fallback_level for s in "ABCD"] == ["stored", "fresh", "neighbour", "fresh"]
    assert (got["A"].temperature, got["A"].humidity, got["A"].observed_at) == (20.0, 75.0, "2026-06-18T12:00:00+00:00")
    assert (got["B"].temperature, got["B"].computed_rainfall_level, got["B"].observed_at) == (31.5, "Red", "2026-06-18T19:45+08:00")
    assert got["C"].temperature == 31.5 and (got["D"].temperature, got["D"].computed_rainfall_level) == (27.0, "Orange")
    assert got["D"].observed_at == "2026-06-18T20:00:00+08:00"
    slots = {r.id: r for r in forecasts.collect()}
    assert set(slots) == {"FCT-BB-0001", "FCT-BB-0002", "FCT-CC-0001", "FCT-CC-0002", "FCT-DD-0001", "FCT-DD-0002"}
    assert [slots[f"FCT-BB-000{i}"].computed_rainfall_level for i in (1, 2)] == ["Yellow", "Red"]
    assert (slots["FCT-DD-0001"].forecast_date, slots["FCT-DD-0001"].rainfall_sum_mm, slots["FCT-DD-0001"].humidity_mean) == ("2026-06-19", 7.5, 66.0)

    path = str(tmp_path / "current")
    tables.replace_table(current, path)
    report = tables.load_update_only(rows.select(*current.columns), path, ["station"]).first()
    assert (report.matched, report.unmatched) == (3, 1)
    stored = {r.station: r for r in tables.read_table(spark, path).collect()}
    assert set(stored) == {"A", "B", "C"} and stored["B"].temperature == 31.5

    stale = {r.station: r for r in weather.watchdog(stations, current, payloads, now()).collect()}
    assert {s: r.fallback_level for s, r in stale.items()} == {"A": "constant", "C": "constant", "D": "fresh"}
    assert stale["A"].temperature == 28.5 and stale["A"].observed_at == "2026-06-18T20:00:00+08:00"


def test_weather_jobs_that_store(spark, tmp_path):
    stations = spark.createDataFrame([("A", "AA", 0), ("B", "BB", 1), ("C", "CC", 2)], "station string, code string, station_seq bigint")
    payloads = spark.createDataFrame([("A", None, None), ("B", primary(31.5, 40.0), None), ("C", "{", None)], "station string, primary string, secondary string")
    current, slots = str(tmp_path / "current"), str(tmp_path / "slots")
    with pytest.raises(ValueError):
        weather.store_refresh(stations, payloads, current, slots, now())
    tables.replace_table(spark.createDataFrame(
        [("A", 20.0, None, 1.0, 2.0, "2026-06-18T10:00:00+00:00", None), ("C", 1.0, 1.0, 1.0, 1.0, "junk", None), ("Z", 9.0, 9.0, 9.0, 9.0, None, None)],
        "station string, temperature double, humidity double, rainfall_mm double, wind_speed double, fetched_at string, observed_at string"), current)
    tables.replace_table(spark.createDataFrame(
        [("FCT-BB-0001", "B", None), ("FCT-CC-0002", "C", 5.0), ("FCT-CC-0009", "C", 5.0), ("FCT-BB-0002", "X", 7.0)], "id string, station string, temp_max double"), slots)
    for _ in range(2):
        report = {r.table: (r.matched, r.unmatched) for r in weather.store_refresh(stations, payloads, current, slots, now()).collect()}
        assert report == {"current": (2, 1), "forecasts": (2, 2)}
        stored = {r.station: r for r in tables.read_table(spark, current).collect()}
        assert {s: r.temperature for s, r in stored.items()} == {"A": 20.0, "C": 31.5, "Z": 9.0}
        assert stored["A"].fetched_at == "2026-06-18T12:00:00+00:00" and stored["Z"].fetched_at is None
        held = {(r.id, r.station): r.temp_max for r in tables.read_table(spark, slots).collect()}
        assert held[("FCT-CC-0009", "C")] == 5.0 and held[("FCT-BB-0002", "X")] == 7.0 and held[("FCT-BB-0001", "B")] is not None
        assert held[("FCT-CC-0002", "C")] != 5.0

    later = F.to_timestamp(F.lit("2026-06-19 12:00:00"))
    answers = spark.createDataFrame([("A", None, SECONDARY), ("C", None, None)], "station string, primary string, secondary string")
    report = weather.store_watchdog(stations, answers, current, later).first()
    assert (report.matched, report.unmatched) == (2, 1)
    got = {r.station: r.temperature for r in tables.read_table(spark, current).collect()}
    assert got == {"A": 27.0, "C": 28.5, "Z": 9.0}


def test_repair_job(spark):
    rows = [
        ("external_acad_0003", "2026-01-02", "City of X", "Number coding off", "CLASS_SUSPENSION", True, "CLASS_SUSPENSION", "same text"),
        ("external_acad_0001", "2026-01-03", "Uni", "Classes suspended", "CLASS_SUSPENSION", True, "CLASS_SUSPENSION", "same text"),
        ("external_lgu_0009", "2026-01-01", "Uni", "Classes suspended", "CLASS_SUSPENSION", True, "CLASS_SUSPENSION", "other text"),
        ("x", "2026-01-04", "Uni", "Exam lifted", "EXAM_WEEK", True, "EXAM_WEEK", None), ("y", "2026-01-05", "Uni", "Ball", None, False, None, " "),
    ]
    df = spark.createDataFrame(rows, "id string, scraped_at string, source_name string, event_name string, event_code string, is_cancellation boolean, cancellation_target_code string, post_text string")
    once = repair.repair_events(df.withColumn("image_text", F.lit(None).cast("string")))
    got = {r.id: (r.category, r.event_code, r.is_cancellation, r.cancellation_target_code) for r in once.collect()}
    assert got == {
        "external_lgu_0001": ("lgu", "CIVIC_MAINTENANCE", False, None), "external_acad_0001": ("acad", "CLASS_SUSPENSION", False, None),
        "external_acad_0002": ("acad", "EXAM_WEEK", True, "EXAM_WEEK"), "external_acad_0003": ("acad", None, False, None)}
    twice = repair.repair_events(once)
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_answers(spark):
    texts = [('{"category":"lgu","event_name":"None","is_cancellation":true}',), ("not json",), (None,)]
    got = [r.a for r in spark.createDataFrame(texts, "t string").select(nested.parse_answer(F.col("t")).alias("a")).collect()]
    assert (got[0].category, got[0].event_name, got[0].is_cancellation) == ("lgu", None, True)
    assert got[1].category is None and got[2].is_cancellation is False


def test_year_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(2023, 1, []), (2024, 2, []), (2024, 3, ["bad"])], "year int, v int, rejects array<string>")
    tables.replace_partitions(spark.createDataFrame([(2024, 9), (2025, 9)], "year int, v int"), path, ["year"])
    status = tables.write_accepted_groups(rows, path, "year")
    assert sorted((r.year, r.accepted) for r in status.collect()) == [(2023, True), (2024, False)]
    assert sorted((r.year, r.v) for r in spark.read.parquet(path).collect()) == [(2023, 1), (2024, 9), (2025, 9)]


def test_quotes_and_line_breaks_stay_in_their_cell(spark, tmp_path):
    (tmp_path / "book.csv").write_text('text,n\n"he said ""hi"", ok",1\n"two\nlines",2\n')
    rows = files.read_sheet(spark, str(tmp_path / "book.csv")).orderBy("n").collect()
    assert [(r.text, r.n) for r in rows] == [('he said "hi", ok', "1"), ("two\nlines", "2")]


def test_impossible_dates_are_rejects(spark):
    from railtide.functions import labels

    df = spark.createDataFrame([("29-Feb",), ("28-Feb",), ("Total",), ("13/1/2023",), (None,)], "c string")
    got = [tuple(r) for r in df.select(labels.service_date(F.col("c"), F.lit(2023)).isNotNull(), labels.service_date_reject(F.col("c"), F.lit(2023))).collect()]
    assert got == [(False, "bad_date"), (True, None), (False, None), (False, "bad_date"), (False, None)]
