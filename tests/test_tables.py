import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.operators import blocking, ordering, standardize, survivorship
from kinlink.plans.linkage import link
from kinlink.plans.settings import PHASES, Settings
from kinlink.schema import LEFT_SCHEMA, RIGHT_SCHEMA, require_columns
from kinlink.sources import lookups, tables
from kinlink.sources.metrics import log_metrics, read_metrics


def test_record_ids(spark):
    df = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("k")).repartition(7)
    numbered = ordering.number_rows(df, ["k"], "n")
    assert numbered.where("n != k").count() == 0 and numbered.count() == 1000
    with pytest.raises(ValueError, match="already"):
        ordering.add_record_ids(df, df, "k", ["k"], ["k"])
    with pytest.raises(ValueError, match="empty"):
        ordering.add_record_ids(df.limit(0), df, "n", ["k"], ["k"])


def test_rank_in_group_splits_a_large_group(spark):
    df = spark.range(200).selectExpr("id", "IF(id < 150, 'hot', 'cold') AS g")
    ranked = ordering.rank_in_group(df, ["g"], "id", "n", width=16)
    assert ranked.where("n != IF(g = 'hot', id + 1, id - 149)").count() == 0


def test_survivors(spark):
    rows = [(1, 10, 2), (2, 10, 2), (3, 10, 1), (4, 20, 5), (5, 20, 3), (6, 20, 3), (7, 30, None), (8, 0, 4), (9, 0, 1), (10, None, 2)]
    df = spark.createDataFrame(rows, "record_id long, PrimaryFEIN long, AddressTypeCode long")

    def ids(**options):
        return sorted(r["record_id"] for r in survivorship.keep_best_codes(df, **options).collect())

    assert ids() == [1, 2, 5, 10]  # ids 0 and null are one group
    assert ids(keep_uncoded=True) == [1, 2, 5, 7, 10]
    assert ids(missing_ids="pass") == [1, 2, 5, 8, 9, 10]
    dup = spark.createDataFrame([(2, "a"), (1, "a"), (3, None), (4, None)], "record_id long, k string")
    assert sorted(r["record_id"] for r in survivorship.keep_first(dup, ["k"]).collect()) == [1, 3]


def test_batches_close_at_the_budget(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 10), ("z", 0), ("e", 4)], "k string, total_comparisons long")
    got = {r["k"]: r["batch"] for r in blocking.batches(counts, 5).collect()}
    assert got == {"z": 1, "a": 1, "b": 1, "c": 1, "e": 2, "d": 3}
    each = {r["k"]: r["batch"] for r in blocking.batches(counts, 100).collect()}
    assert each == {"z": 1, "a": 2, "b": 3, "c": 4, "e": 5, "d": 6}


def test_required_columns(spark):
    with pytest.raises(ValueError, match="'b'"):
        require_columns(spark.range(1), ["id", "b"])
    with pytest.raises(ValueError, match="missing"):
        standardize.cast_integers(spark.range(1), ["x"], True)


def test_lookups(spark, tmp_path):
    sheet = tmp_path / "abbr.csv"
    sheet.write_text("t\n\nnote\nPrimary,Common,Standard\nALLEY,ALLEE,ALY\nAVENUE,AV,AVE\nSTREET,,ST\nALLEY,ALLY,AL\nX,Y,\n")
    loaded = lookups.load_abbreviation_sheet(spark, str(sheet))
    mapping = lookups.abbreviation_mapping(loaded)
    assert list(mapping.items()) == [("ALLEY", "AL"), ("ALLEE", "ALY"), ("AVENUE", "AVE"), ("AV", "AVE"), ("STREET", "ST"), ("ALLY", "AL")]
    narrow = tmp_path / "narrow.csv"
    narrow.write_text("1\n2\n3\nA,B\n")
    with pytest.raises(ValueError, match="columns"):
        lookups.load_abbreviation_sheet(spark, str(narrow))
    words = tmp_path / "words.txt"
    words.write_text("the\t\n of \nThe\n")
    assert lookups.load_words(spark, str(words)) == ["OF", "THE"]
    with pytest.raises(ValueError):
        lookups.load_words(spark, "")
    with pytest.raises(ValueError, match="more than 1"):
        lookups.load_words(spark, str(words), most=1)
    with pytest.raises(FileNotFoundError):
        lookups.load_words(spark, str(tmp_path / "none.txt"))
    quoted = tmp_path / "quoted.csv"
    quoted.write_text('1\n2\n3\n"A, or so",B\nx,y\n')
    with pytest.raises(ValueError, match="columns"):
        lookups.load_abbreviation_sheet(spark, str(quoted))
    quoted.write_text('1\n2\n3\n"A, or so",B,C\n"LONG, ROAD","L\nR",LR\n')
    assert lookups.abbreviation_mapping(lookups.load_abbreviation_sheet(spark, str(quoted))) == {"LONG, ROAD": "LR", "L\nR": "LR"}


def test_create_table_sql():
    schema = T.StructType().add("a", "long").add("b", "double").add("c", "string").add("d", "timestamp").add("e", "boolean")
    schema = schema.add("f", T.IntegerType()).add("g", "float").add("h", T.TimestampNTZType()).add("two words", "short")
    columns = 'a INTEGER, b FLOAT, c STRING, d TIMESTAMP, e STRING, f INTEGER, g FLOAT, h TIMESTAMP, "two words" INTEGER'
    assert tables.create_table_sql("t", schema) == f"CREATE TABLE IF NOT EXISTS t ({columns});"


def test_sources_refuse_bad_input(spark, tmp_path):
    with pytest.raises(ValueError, match="section"):
        tables.jdbc_options({}, "LEFT_DB")
    with pytest.raises(ValueError, match="url"):
        tables.jdbc_options({"LEFT_DB": {"user": "x"}}, "LEFT_DB")
    assert tables.jdbc_options({"LEFT_DB": {"url": "jdbc:x"}}, "LEFT_DB") == {"url": "jdbc:x"}
    with pytest.raises(ValueError, match="name"):
        tables.append_table(spark.range(1), "")
    with pytest.raises(ValueError, match="empty"):
        tables.append_table(spark.range(0), "t")
    with pytest.raises(FileNotFoundError):
        tables.load_snapshot(spark, str(tmp_path / "none"))
    with pytest.raises(TypeError):
        tables.save_snapshot("x", str(tmp_path / "none"))


def test_stage_cache_follows_its_inputs(spark, tmp_path):
    path, calls = str(tmp_path / "stage"), []

    def build(n):
        calls.append(n)
        return spark.range(n).selectExpr("lpad(CAST(id AS STRING), 5, '0') AS zip")

    for n, key in ((2, "a"), (2, "a"), (3, "b")):
        stage = tables.cached_stage(spark, path, tables.fingerprint(key), lambda n=n: build(n))
    assert calls == [2, 3] and stage.count() == 3 and dict(stage.dtypes) == {"zip": "string"}


def test_fingerprint_sees_plans_and_files(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(100).write.parquet(path)
    table = spark.read.parquet(path)
    low, high = tables.fingerprint(table.where("id < 10")), tables.fingerprint(table.where("id >= 10"))
    assert low != high and low == tables.fingerprint(spark.read.parquet(path).where("id < 10"))
    spark.range(50).write.mode("overwrite").parquet(path)
    assert tables.fingerprint(spark.read.parquet(path).where("id < 10")) != low
    with pytest.raises(ValueError, match="version"):
        tables.fingerprint(spark.range(5))
    assert tables.fingerprint(spark.range(5), version="1") != tables.fingerprint(spark.range(5), version="2")
    assert tables.fingerprint(spark.range(5), version="1") != tables.fingerprint(spark.range(1), version="1")


def test_fingerprint_reads_the_whole_plan(spark, tmp_path):
    path, other = str(tmp_path / "table"), str(tmp_path / "other")
    spark.range(100).write.parquet(path)
    spark.range(50).write.parquet(other)

    def wide(last):
        table = spark.read.parquet(path)
        return table.select(*[(F.col("id") + i).alias(f"c{i}") for i in range(158)], (F.col("id") * last).alias("last"))

    def mapped(n):
        return spark.read.parquet(path).select(F.udf(lambda x: x + n, "long")("id"))

    def lambdas(n):
        return spark.read.parquet(path).select(F.transform(F.array("id"), lambda x: x + n).alias("x"))

    def listed(n):
        return spark.read.parquet(path).where(F.col("id").isin([*range(40), n]))

    def nested(n):
        few = spark.read.parquet(other).where(F.col("id") > n)
        return spark.sql("SELECT * FROM {a} WHERE id IN (SELECT id FROM {b})", a=spark.read.parquet(path), b=few)

    for make in (wide, mapped, lambdas, listed, nested):
        assert tables.fingerprint(make(77)) == tables.fingerprint(make(77)) != tables.fingerprint(make(78)), make.__name__
    before = tables.fingerprint(nested(1))
    spark.range(51).write.mode("overwrite").parquet(other)  # a table that only a subquery reads
    assert tables.fingerprint(nested(1)) != before
    first = tables.fingerprint(spark.read.parquet(path))
    file = next((tmp_path / "table").glob("part-*"))
    file.rename(file.with_name("part-renamed.parquet"))
    assert tables.fingerprint(spark.read.parquet(path)) != first
    shared = spark.sparkContext.broadcast(3)
    with pytest.raises(ValueError, match="broadcast"):
        tables.fingerprint(spark.read.parquet(other).select(F.udf(lambda x: x + shared.value, "long")("id")))


def test_settings_are_told_apart():
    settings = Settings(abbreviations={"STREET": "ST"})
    assert tables.fingerprint(settings) == tables.fingerprint(Settings(abbreviations={"STREET": "ST"}))
    assert tables.fingerprint(settings) != tables.fingerprint(Settings(abbreviations={"STREET": "STR"}))
    makers = [tables.fingerprint(Settings(make_encoder=lambda n=n: n)) for n in (1, 2)]
    assert makers[0] != makers[1] and tables.fingerprint("1") != tables.fingerprint(1)


def test_a_job_goes_on_behind_its_last_complete_stage(spark, tmp_path, monkeypatch):
    from dataclasses import replace

    from kinlink.operators.rules import Rule
    from kinlink.plans import linkage

    paths = {n: str(tmp_path / n) for n in ("left", "right")}
    names = ["Acme Boats", "Blue Door Bakery", "Corner Shoes", "Delta Farm"]
    for n, schema, column, order in (("left", LEFT_SCHEMA, "PrimaryInsuredName", "FileNumber"), ("right", RIGHT_SCHEMA, "business_name", "tradestyle")):
        given = [
            {column: name, order: str(i), "PrimaryFEIN": str(i), "StreetAddress": f"{i} Oak Ave", "physical_street_address": f"{i} Oak Ave", "City": "ERIE", "physical_city": "ERIE", "Zipcode": "16501", "physical_zip": "16501", "AddressTypeCode": 2}
            for i, name in enumerate(names)
        ]
        spark.createDataFrame(rows(schema, *given), schema).write.parquet(paths[n])
    store = str(tmp_path / "ledger")

    def run(settings=Settings(), stop_at=None):
        real = linkage.run_phase

        def stopping(left, right, phase, *more):
            if phase.number == stop_at:
                raise RuntimeError("the driver is lost")
            return real(left, right, phase, *more)

        with monkeypatch.context() as patched:
            patched.setattr(linkage, "run_phase", stopping)
            done = link(*(spark.read.parquet(paths[n]) for n in ("left", "right")), ["FileNumber"], ["tradestyle"], settings, store)
        return [s.name for s in done.stages if not s.reused], sorted((r["left_id"], r["right_id"]) for r in done.matches.collect())

    two = PHASES[:2]
    with pytest.raises(RuntimeError):
        run(Settings(phases=two), stop_at=2)
    everything = [(i, i) for i in range(1, 5)]
    assert run(Settings(phases=two)) == (["phase-2", "matches"], everything)
    next((tmp_path / "ledger" / "phase-2").glob("*/_SUCCESS")).unlink()  # as if the write had been cut off
    stricter = replace(PHASES[1], rules=(Rule("Method 9", 99, 99, 99),))
    assert run(Settings(phases=two)) == (["phase-2"], everything)
    assert run(Settings(phases=(two[0], stricter))) == (["phase-2", "matches"], everything)


def test_a_rerun_without_rows_leaves_none_behind(spark, tmp_path):
    path = str(tmp_path / "matches")
    df = spark.createDataFrame([(1, 1), (2, 2)], "left_id long, phase int")
    tables.write_matches(df, path)
    tables.write_matches(df.where("phase = 1"), path, phases=[1, 2])
    assert [tuple(r) for r in tables.read_matches(spark, path).collect()] == [(1, 1)]
    tables.write_matches(df.limit(0), path, phases=[1])
    assert tables.read_matches(spark, path).count() == 0 and tables.read_matches(spark, path).columns == ["left_id", "phase"]


def test_an_interrupted_run_publishes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "matches")
    first, second = (spark.createDataFrame([(n, p) for p in (1, 2)], "left_id long, phase int") for n in (10, 20))
    with pytest.raises(FileNotFoundError):
        tables.read_matches(spark, path)
    tables.write_matches(first, path)

    def lost(*_):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "_publish", lost)
        with pytest.raises(RuntimeError):
            tables.write_matches(second, path, phases=[1, 2])
    assert sorted(map(tuple, tables.read_matches(spark, path).collect())) == [(10, 1), (10, 2)]
    tables.write_matches(second.where("phase = 2"), path, "csv")  # another form for another phase
    assert sorted(map(tuple, tables.read_matches(spark, path).collect())) == [(10, 1), (20, 2)]
    assert len(list((tmp_path / "matches").glob("run-*"))) == 2  # what the cut-off run left is gone


def test_phases_of_any_number_are_counted(spark):
    from kinlink.operators.stats import phase_counts

    matches = spark.createDataFrame([(1, 1), (2, 4), (3, 4)], "left_id long, phase int")
    rows = [tuple(r) for r in phase_counts(spark.range(10), matches, [1, 2, 4]).orderBy("phase").collect()]
    assert rows == [(1, 10, 1, 9), (2, 9, 0, 9), (4, 9, 2, 7)]
    assert phase_counts(spark.range(10), matches).count() == 4


def test_intermediates_are_discarded(spark):
    from pathlib import Path

    from kinlink import storage

    one, other = storage.materialize(spark.range(3).toDF("id"), "one"), storage.materialize(spark.range(4).toDF("id"), "other")
    folder = Path(one.inputFiles()[0].removeprefix("file://")).parent
    storage.discard(one)
    assert not folder.exists() and other.count() == 4
    storage.discard(spark.range(1))  # no stored table: nothing to delete


def test_metrics(spark, tmp_path):
    path = str(tmp_path / "metrics")
    assert read_metrics(spark, path, "r").count() == 0
    log_metrics(spark.createDataFrame([("x", 0, 0), ("y", 4, 1)], "description string, rows_before long, rows_after long"), path, "r")
    got = {r["Description of Operation"]: r["Percentage Change"] for r in read_metrics(spark, path, "r").collect()}
    assert got == {"x": 0.0, "y": 25.0} and read_metrics(spark, path, "other").count() == 0


def rows(schema, *given):
    return [tuple(g.get(f.name) for f in schema.fields) for g in given]


def test_link_from_raw_tables(spark):
    left = rows(
        LEFT_SCHEMA,
        {"FileNumber": "2", "PrimaryFEIN": "12-1", "PrimaryInsuredName": "AcmeInc", "StreetAddress": "5 North Main Street", "City": "erie", "State": "PA", "Zipcode": "16501", "AddressTypeCode": 2},
        {"FileNumber": "1", "PrimaryFEIN": "12-1", "PrimaryInsuredName": "Acme", "StreetAddress": "PA", "City": "Erie", "State": "PA", "Zipcode": "16501", "AddressTypeCode": 3},
        {"FileNumber": "3", "PrimaryFEIN": "13", "PrimaryInsuredName": "Blue Door Bakery", "StreetAddress": "9 Oak Ave", "City": "PITSBURGH", "State": "PA", "Zipcode": None, "AddressTypeCode": 1},
        {"FileNumber": "4", "PrimaryFEIN": "14", "PrimaryInsuredName": "Nobody", "StreetAddress": "1 X", "City": None, "State": "PA", "Zipcode": "16501", "AddressTypeCode": 1},
    )
    right = rows(
        RIGHT_SCHEMA,
        {"business_name": "Acme Corp", "physical_street_address": "5 N. Main St", "physical_city": "ERIE", "physical_zip": "16501-0001"},
        {"business_name": "The Blue Door Bakery", "physical_street_address": "9 Oak Avenue", "physical_city": "PITTSBURGH", "physical_zip": "15201"},
    )
    a, b = spark.createDataFrame(left, LEFT_SCHEMA), spark.createDataFrame(right, RIGHT_SCHEMA)
    done = link(a, b, ["FileNumber"], ["business_name"], Settings(abbreviations={"STREET": "ST", "AVENUE": "AVE"}))
    assert sorted((r["left_id"], r["right_id"], r["method"], r["phase"]) for r in done.matches.collect()) == [(2, 1, "Method 1", 1), (3, 2, "Method 1", 2)]
    out = {r["pcrb_FileNumber"]: r["dnb_business_name"] for r in done.output.collect()}
    assert out == {"2": "Acme Corp", "3": "The Blue Door Bakery"}
    assert [r["FileNumber"] for r in done.unmatched_left.collect()] == ["4"] and done.unmatched_right.count() == 0
    metrics = {r["description"]: (r["rows_before"], r["rows_after"]) for r in done.metrics.collect()}
    assert metrics == {"Apply Hierarchy Method": (4, 3), "Drop Duplicates": (3, 3), "Number of matched rows": (3, 2), "Number of unmatched rows": (3, 1)}
    stats = [r.asDict() for r in done.stats[1].collect()]
    assert stats == [{"Zipcode": "16501", "Total_PCRB_Records": 1, "Total_DNB_Records": 1, "Total_Matched_Records": 1, "Method1_Matched_Records": 1, "Method2_Matched_Records": None, "Match_Percentage": 100.0}]
    assert [tuple(r) for r in done.phases.orderBy("phase").collect()] == [(1, 3, 1, 2), (2, 2, 1, 1), (3, 1, 0, 1)]
