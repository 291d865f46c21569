"""Records over several lines, read in parts: equal to reading whole files, and by many tasks."""

import contextlib
import csv
import io
import json
import random

import pytest
from pyspark.serializers import CloudPickleSerializer

from jobtide.plans import silver
from jobtide.sources import readers, records
from jobtide.sources.store import TableStore
from jobtide.streaming import ingest
from workload import registry


@contextlib.contextmanager
def parts_of(spark, size):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in before:
        spark.conf.set(key, str(size))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def field(rng):
    kind = rng.random()
    if kind < 0.3:
        return rng.choice(["", "plain", "ünï", 'in"side', "1"])
    words = [rng.choice(["a", "line\nbreak", "\r\n", 'said ""hi""', ",", "日本", "\n\n", "x" * rng.randint(1, 60), '""'])
             for _ in range(rng.randint(0, 6))]
    return '"' + " ".join(words) + '"'


def csv_file(seed, rows, end):
    rng = random.Random(seed)
    lines = ["job_id,inferred,type"]
    lines += [f"{i},{field(rng)},{field(rng)}" for i in range(rows)]
    return (end.join(lines) + (end if seed % 2 else "")).encode()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [60, 700])
def test_csv_in_parts_is_the_whole_file(spark, tmp_path, size, end):
    for seed in range(3):
        (tmp_path / f"{seed}.csv").write_bytes(csv_file(seed, 25, end))
    with parts_of(spark, size):
        cut = readers.read_csv(spark, str(tmp_path), "benefits", multiline=True, split=True)
        got = sorted(map(tuple, cut.collect()), key=repr)
    whole = readers.read_csv(spark, str(tmp_path), "benefits", multiline=True, split=False)
    assert got == sorted(map(tuple, whole.collect()), key=repr) and len(got) == 75


def test_csv_against_the_csv_module(spark, tmp_path):
    data = csv_file(8, 60, "\n")
    (tmp_path / "b.csv").write_bytes(data)
    rows = list(csv.reader(io.StringIO(data.decode(), newline="")))[1:]
    with parts_of(spark, 128):
        got = readers.read_csv(spark, str(tmp_path / "b.csv"), "benefits", multiline=True, split=True).collect()
    assert sorted((r.job_id, r.inferred or "", r.type or "") for r in got) == sorted(tuple(r) for r in rows)


def test_record_over_many_parts_blank_lines_and_header_only(spark, tmp_path):
    long = "\n".join(["one more line"] * 40)
    (tmp_path / "a.csv").write_text(f'job_id,"inf\nerred",type\n\n1,"{long}",x\n  \n2,y,"z"')
    (tmp_path / "b.csv").write_text("job_id,inferred,type\n")
    (tmp_path / "c.csv").write_text("")
    with parts_of(spark, 64):
        cut = readers.read_csv(spark, str(tmp_path), "benefits", multiline=True, split=True)
        assert sorted(map(tuple, cut.collect())) == [("1", long, "x"), ("2", "y", "z")]


@pytest.mark.parametrize("line", ["1,2", "1,2,3,4", '1,2,"3'])
def test_csv_in_another_form_fails(spark, tmp_path, line):
    (tmp_path / "b.csv").write_text(f"job_id,inferred,type\n0,0,0\n{line}\n5,5,5\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv(spark, str(tmp_path), "benefits", multiline=True, split=True).collect()


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    text = "job_id,inferred,type\n" + "".join(f'{i},"two\nlines, ""{i}""",x\n' for i in range(20_000))
    (tmp_path / "b.csv").write_text(text)
    elements = ",\n".join(json.dumps({"job_id": i, "industry_id": i % 150}, indent=1) for i in range(20_000))
    (tmp_path / "j.json").write_text(f"[\n{elements}\n]\n")
    with parts_of(spark, 65_536):
        rows = readers.read_csv(spark, str(tmp_path / "b.csv"), "benefits", multiline=True)  # large: split unasked
        assert rows.rdd.getNumPartitions() > 6 and rows.count() == rows.distinct().count() == 20_000
        data = readers.read_json_array(spark, str(tmp_path / "j.json"))
        assert data.rdd.getNumPartitions() > 6 and silver.job_industries(data).count() == 20_000


RECORDS = [
    {"company_id": 1, "name": "a [b] {c} \"d\" \\", "nested": {"x": [1, 2, {"y": ","}]}, "city": "]"},
    {"company_id": 2, "name": "é\n日本", "list": [], "none": None},
    {"company_id": 3, "name": "long " * 60},
    {"company_id": 4},
]


@pytest.mark.parametrize("indent", [None, 0, 3])
@pytest.mark.parametrize("size", [100, 100_000])
def test_json_array_in_parts(spark, tmp_path, indent, size):
    (tmp_path / "a.json").write_text("\n\n " + json.dumps(RECORDS * 2, indent=indent) + "\n")
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text(json.dumps(RECORDS, indent=indent, ensure_ascii=False).replace(": ", ":\r\n "))
    with parts_of(spark, size):
        got = [json.loads(r[0]) for r in readers.read_json_array(spark, str(tmp_path)).selectExpr("to_json(data)").collect()]
    dumped = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(dumped, got)) == sorted(dumped([r]) for r in RECORDS * 3)


@pytest.mark.parametrize("text", ['{"a": 1}', '[{"a": 1}', '[1] x', "[1]\n[2]", "nonsense", '[{"a": 1]', "[{a}]"])
def test_json_in_another_form_fails(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="(?i)array of JSON|arrays of JSON|malformed"):
        readers.read_json_array(spark, str(tmp_path)).collect()


def test_incremental_load_in_parts(spark, tmp_path):
    store, folder = TableStore(spark, root=str(tmp_path / "store")), tmp_path / "in" / "benefits"
    folder.mkdir(parents=True)
    with parts_of(spark, 100):
        for seed in range(2):
            (folder / f"{seed}.csv").write_bytes(csv_file(seed, 40, "\n"))
            for _ in range(2):
                ingest.load_table(store, str(tmp_path / "in"), "benefits", multiline=True)
    whole = readers.read_csv(spark, str(folder), "benefits", multiline=True, split=False)
    assert sorted(map(tuple, store.read("bronze", "benefits").collect()), key=repr) == sorted(
        map(tuple, whole.collect()), key=repr
    )


def test_quoting_rules():
    after = records.quoted_after
    assert [after(x, 0) for x in ("a", 'a"b', '"a', '"a""', '"a"', 'x,"', 'x,"",y', 'x, "', '""', '"""')] == [0, 0, 1, 1, 0, 1, 0, 0, 0, 1]
    assert [after(x, 1) for x in ("a", 'a"', 'a""', 'a"""', '",', '","', '"x",y')] == [1, 0, 1, 0, 0, 1, 0]


def test_spark_tells_lines_that_leave_a_field_open(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choice(['"', '"', '""', ",", "a", " ", "\u2028"]) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    rows = spark.createDataFrame([(x,) for x in lines], "value string")
    got = rows.select("value", records.left_open(rows.value).alias("left_open")).collect()
    assert [r.left_open for r in got] == [bool(records.quoted_after(r.value, 0)) for r in got]
    assert len({r.left_open for r in got}) == 2


def test_files_of_a_record_a_line_are_left_to_spark(spark, tmp_path):
    # One file has records over lines and one other line ends: those two are cut, under odd names.
    plain = "job_id,inferred,type\n\n" + "".join(f'{i},"a, ""{i}""",\n' for i in range(400))
    for name in ("a.csv", "b [1] %20ü.csv", "empty.csv"):
        (tmp_path / name).write_text(plain if name != "empty.csv" else "")

    def read():
        rows = readers.read_csv(spark, str(tmp_path), "benefits", multiline=True)  # large: split unasked
        return rows, rows._jdf.queryExecution().executedPlan().toString()

    with parts_of(spark, 1000):
        rows, plan = read()
        assert "MapInArrow" not in plan and rows.rdd.getNumPartitions() > 6
        assert sorted(map(tuple, rows.collect())) == sorted((str(i), f'a, "{i}"', None) for i in range(400) for _ in "ab")
        (tmp_path / "c [1] %20ü.csv").write_text(plain + 'x,"two\n2,""lines""",y\n')
        (tmp_path / "d.csv").write_bytes(b'job_id,inferred,type\r\n1,"2",3\r\n')
        rows, plan = read()
        assert "MapInArrow" in plan
        got = sorted(map(tuple, rows.collect()), key=repr)
    whole = readers.read_csv(spark, str(tmp_path), "benefits", multiline=True, split=False)
    assert got == sorted(map(tuple, whole.collect()), key=repr) and len(got) == 3 * 400 + 2


def test_no_malformed_record_passes_a_narrow_read(spark, tmp_path):
    (tmp_path / "b.csv").write_text("job_id,inferred,type\n0,0,0\n1,2\n5,5,5\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv(spark, str(tmp_path), "benefits", multiline=True, split=True).select("job_id").collect()


def test_states_of_parts_do_not_travel_with_every_task(spark):
    found = spark.sparkContext.broadcast(({(f"file:/in/part-{i:05d}.csv", 0): 1 for i in range(20_000)}, set()))
    assert len(CloudPickleSerializer().dumps(records._cut(records.CSV, found, True))) < 20_000


def test_arrays_are_written_many_records_to_a_file(spark, tmp_path):
    rows = [(i % 5000, i % 7) for i in range(6000)] + [(None, 1), (None, 1), (3, None)]
    df = spark.createDataFrame(rows, "job_id bigint, industry_id bigint").repartition(3)
    registry.write_arrays(df, "job_id", f"{tmp_path}/in", per_file=2500)
    files = list(tmp_path.glob("in/*/part-*"))
    assert len(files) == 3  # two of 2500 jobs each, one without a job
    texts = [f.read_text() for f in files]
    got = [(e.get("job_id"), e.get("industry_id")) for t in texts for e in json.loads(t)]
    assert sorted(got, key=str) == sorted(rows, key=str) and all("\n" in t for t in texts)


def test_parts_grow_with_the_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x" * 64_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for least, size in ((1000, 4000), (5000, 5000)):
        with registry._small_parts(spark, str(tmp_path), least, 16):
            assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(size)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
