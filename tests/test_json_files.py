import json
import random

import pytest
from pyspark.sql import functions as F

from shelfline.sources import json_files
from shelfline.sources.json_files import normalize_json_files, write_json_lines
from shelfline.sources.manifest import manifest_scan
from shelfline.sources.raw import scan_inventory_raw

TARGET = "raw/batch/inventory-raw/"


def by_hand(text):
    """Records of one file, or None when the file fails, with a plain JSON parser."""
    try:
        doc = json.loads(text)
        if isinstance(doc, list):
            return doc or None
        return [doc] if isinstance(doc, dict) else None
    except json.JSONDecodeError:
        pass
    try:
        return [json.loads(line) for line in text.split("\n") if line.strip()] or None
    except json.JSONDecodeError:
        return None


A = {"a": 1, "s": 'x"],[{\\', "n": [1, [2, {"k": "]"}]]}
B = {"a": 2, "s": "{[,", "n": []}
FILES = {
    "lines": "\n".join(json.dumps(r) for r in (A, B, A)),
    "blank_between": json.dumps(A) + "\n\n  \n" + json.dumps(B) + "\n",
    "one_object": json.dumps(A),
    "pretty_object": json.dumps(A, indent=2),
    "array_one_line": json.dumps([A, B]),
    "array_pretty": json.dumps([A, B, A], indent=4),
    "array_per_line": "[\n" + ",\n".join(json.dumps(r) for r in (A, B, A)) + "\n]",
    "array_first_on_bracket": "[" + ",\n".join(json.dumps(r) for r in (A, B)) + "]",
    "array_leading_commas": "[" + json.dumps(A) + "\n," + json.dumps(B) + "\n]",
    "array_of_scalars": '[1,\n"two,",\n[3,\n4],\nnull\n]',
    "array_with_tabs": "[\n\t" + json.dumps(A) + ",\t\n\t" + json.dumps(B) + "\r\n]",
    "lines_of_scalars": "1\n2",
    "lines_of_arrays": "[1]\n[2]",
    "broken_line": json.dumps(A) + '\n{"a":\n' + json.dumps(B),
    "broken_last_line": json.dumps(A) + "\n{oops",
    "scalar": "5",
    "empty_array": "[]",
    "empty_array_lines": "[\n]",
    "empty": "",
    "only_blank": "\n \n",
    "trailing_comma": "[\n1,\n2,\n]",
    "unclosed": "[\n1,\n2",
    "cut_after_comma": "[\n1,\n2,",
    "missing_comma": "[\n{}\n{}\n]",
    "double_comma": "[\n1,\n,\n2\n]",
    "two_arrays": "[\n1,\n2\n]\n[\n3,\n4\n]",
    "closed_early": "[\n1\n],\n2\n]",
    "object_then_text": json.dumps(A, indent=2) + "\nx",
    "wrong_bracket": "[\n1,\n2\n}",
    "comma_first": ",\n1\n]",
    "commas_first": "[\n1\n, 2\n,[3,\n4]\n]",
    "commas_on_both_sides": "[\n1,\n,2\n]",
    "comma_alone": "[\n1\n,\n2\n]",
    "commas_alone_twice": "[\n1\n,\n,\n2\n]",
    "leading_then_nothing": "[\n1\n,\n]",
    "leading_then_end": "[\n1\n,",
}


def read(spark, folder, **options):
    got = normalize_json_files(spark, str(folder), TARGET, **options)
    records = {}
    for r in got.records.select("file", F.to_json("record").alias("j")).collect():
        records.setdefault(r.file.split("/")[-1], []).append(json.loads(r.j))
    return records, {r.file.split("/")[-1]: r for r in got.status.collect()}, got


def canonical(records):
    return sorted(json.dumps(r, sort_keys=True) for r in records)


@pytest.mark.parametrize("split", ["128m", "16"])
def test_every_shape_agrees_with_a_plain_parser(spark, tmp_path, split):
    """Also with read blocks of 16 bytes, so that every file spans many blocks."""
    for name, text in FILES.items():
        (tmp_path / f"{name}.json").write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        records, status, _ = read(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, text in FILES.items():
        want, file = by_hand(text), f"{name}.json"
        verdict = status[file]
        if want is None:
            assert verdict.status == "FAILED" and verdict.reason, name
            assert verdict.records_converted == 0 and file not in records, name
        else:
            assert verdict.status == "SUCCESS" and verdict.reason is None, name
            assert canonical(records[file]) == canonical(want), name
            assert verdict.records_converted == len(want), name
    assert len(status) == len(FILES)


def test_random_documents(spark, tmp_path):
    rng = random.Random(7)
    texts = {}
    for i in range(40):
        rows = [
            {"id": j, "t": "".join(rng.choice('ab"\\[]{},: ') for _ in range(rng.randint(0, 12)))}
            for j in range(rng.randint(1, 6))
        ]
        text = rng.choice([
            json.dumps(rows), json.dumps(rows, indent=rng.choice([0, 2])),
            "\n".join(map(json.dumps, rows)), "[\n" + ",\n".join(map(json.dumps, rows)) + "\n]",
        ])
        if rng.random() < 0.4:
            cut = rng.randrange(len(text))
            text = text[:cut] + rng.choice(["", ",", "]", "}", "\n", '"']) + text[cut + 1 :]
        texts[f"f{i}.json"] = text
        (tmp_path / f"f{i}.json").write_text(text)
    records, status, _ = read(spark, tmp_path)
    for file, text in texts.items():
        want = by_hand(text)
        assert (status[file].status == "SUCCESS") == (want is not None), text
        assert canonical(records.get(file, [])) == canonical(want or []), text


@pytest.mark.parametrize("separator", [",\n", "\n,"])
def test_one_file_holding_most_records_is_spread(spark, tmp_path, separator):
    """Into pieces, over several tasks, wherever its commas stand."""
    rows = [{"id": i, "pad": "x" * 50} for i in range(5_000)]
    text = "[\n" + separator.join(json.dumps(r, indent=1) for r in rows) + "\n]"
    (tmp_path / "hot.json").write_text(text)
    (tmp_path / "cold.json").write_text(json.dumps(rows[:3]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    # Shuffled text, far below what one task would take, is not gathered into one either.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        records, _, got = read(spark, tmp_path)
        pieces = spark.read.parquet(f"{got.work}/elements")
        # The array on one line is cut as well.
        sizes = pieces.groupBy("file").agg(F.count("*").alias("n"), F.max(F.size("items")).alias("most"))
        assert sorted((r.n, r.most) for r in sizes.collect()) == [(3, 1), (5_000, 1)]
        parts = got.records.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1
    assert sorted(r["id"] for r in records["hot.json"]) == list(range(5_000))


def test_no_task_has_most_records_of_one_file(spark, tmp_path):
    """Not even one of several tasks, as they are where small files lie beside it."""
    rows = [{"id": i, "pad": "x" * 50} for i in range(5_000)]
    (tmp_path / "hot.json").write_text("[\n" + ",\n".join(json.dumps(r, indent=1) for r in rows) + "\n]")
    (tmp_path / "cold.json").write_text(json.dumps(rows[:3]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = normalize_json_files(spark, str(tmp_path), TARGET)
        hot = got.records.filter(F.col("file").endswith("hot.json"))
        tasks = hot.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in tasks) == 5_000
    assert max(r["count"] for r in tasks) < 2_500


SHARED = {
    "braces": json.dumps([A, B, A], indent=2).replace("},\n  {", "}, {"),
    "braces_tight": "[{\n" + '"a": 1\n},{\n"s": "},{"\n},{\n"b": [1,\n2], "c": {"d": [[[[5, 6]]]]}\n}]',
    "one_line": json.dumps([A, B, A, [1, 2], [], "x,y", 3, None]),
    "one_line_escapes": '["\\\\", "a\\"", ",\\\\\\",", {"k,\\\\": ",\\""}, 5]',
    "one_line_of_one": json.dumps([A]),
    "several_a_line": '[1, "a,b", [4,\n5], {"x": [6, 7]},\n8, [9, 10], 11\n, 12, 13]',
    "nested_closes_midway": '[{"a": [1,\n2]}, 3, {"b":\n4}, 5]',
    "comma_twice_inside": "[1,, 2\n]",
    "comma_before_end": "[1, 2,]",
    "comma_after_start": "[, 1, 2\n]",
    "comma_missing": '[{"a": 1} {"b": 2}, 3\n]',
    "open_string": '[1, "a, 2\n]',
    "control_characters": '[1, "a\x01, 2\x02", 3\x03]',
    "two_on_a_line": "[1, 2], [3, 4]",
    "end_missing": "[1, 2, 3",
    "end_twice": "[1, 2], 3]",
    "wrong_end": '[{"a": 1], 2}',
    "lines_of_long_arrays": json.dumps([A, B]) + "\n" + json.dumps([B]),
}


@pytest.mark.parametrize("split", ["128m", "16"])
def test_elements_that_share_lines(spark, tmp_path, split):
    for name, text in SHARED.items():
        (tmp_path / f"{name}.json").write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        records, status, _ = read(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, text in SHARED.items():
        want, file = by_hand(text), f"{name}.json"
        assert (status[file].status == "SUCCESS") == (want is not None), name
        assert canonical(records.get(file, [])) == canonical(want or []), name
        assert status[file].records_converted == len(want or []), name


def test_shared_lines_are_cut_into_elements(spark, tmp_path):
    rows = [{"id": i, "pad": "},{" * 20, "n": [i, {"k": [1, 2]}]} for i in range(2_000)]
    (tmp_path / "braces.json").write_text(json.dumps(rows, indent=1).replace("},\n {", "}, {"))
    (tmp_path / "line.json").write_text(json.dumps(rows))
    records, status, got = read(spark, tmp_path)
    pieces = spark.read.parquet(f"{got.work}/elements").groupBy("file").agg(F.count("*").alias("n"), F.max(F.size("items")).alias("most"))
    assert [(r.n, r.most) for r in pieces.collect()] == [(2_000, 1)] * 2
    for file in ("braces.json", "line.json"):
        assert status[file].status == "SUCCESS"
        assert canonical(records[file]) == canonical(rows)


BROKEN = {
    "one_bad_line": lambda rows: [*rows[:700], '{"id": 1, "pad": }', *rows[700:]],
    "cut_off": lambda rows: [*rows, '{"broken": '],
    "open_brace": lambda rows: [*rows[:700], '{"id": {"a": 1}', *rows[700:]],
    "brace_too_many": lambda rows: [*rows[:700], '{"id": 1}}', *rows[700:]],
    "open_string": lambda rows: [*rows[:700], '{"id": "a}', *rows[700:]],
    "array_then_lines": lambda rows: ["[1, 2", "]", *rows],
}


@pytest.mark.parametrize("shape", BROKEN)
def test_broken_json_lines_are_not_brought_together(spark, tmp_path, shape):
    """One broken line among many fails the file, and no piece is made of its lines."""
    rows = [json.dumps({"id": i, "pad": "x" * 40}) for i in range(4_000)]
    (tmp_path / "log.json").write_text("\n".join(BROKEN[shape](rows)))
    (tmp_path / "sound.json").write_text(json.dumps([A, B], indent=1))
    records, status, got = read(spark, tmp_path)
    assert status["log.json"].status == "FAILED" and status["log.json"].reason == json_files.BROKEN
    assert canonical(records.pop("sound.json")) == canonical([A, B]) and not records
    pieces = spark.read.parquet(f"{got.work}/elements")
    assert {r.file.split("/")[-1] for r in pieces.select("file").collect()} == {"sound.json"}


def test_an_object_too_long_for_a_record_fails_unread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(json_files, "LONGEST_RECORD", 1_000)
    (tmp_path / "long.json").write_text(json.dumps({f"k{i}": i for i in range(400)}, indent=1))
    (tmp_path / "array.json").write_text(json.dumps([{"k": i} for i in range(400)], indent=1))
    records, status, got = read(spark, tmp_path)
    assert status["long.json"].status == "FAILED"
    assert status["array.json"].records_converted == len(records["array.json"]) == 400
    assert spark.read.parquet(f"{got.work}/elements").filter(F.col("file").endswith("/long.json")).isEmpty()


def test_lines_are_not_sent_through_the_driver(spark, tmp_path):
    """A table of lines is small on disk, as names repeat, but not where it is sent."""
    n = 80_000
    (tmp_path / "pretty.json").write_text(json.dumps([{"id": i, "k": i % 7} for i in range(n)], indent=1))
    # One page of memory, which the shortest table takes, is up to 32 MiB.
    spark.conf.set("spark.sql.maxBroadcastTableSize", "40m")
    try:
        got = normalize_json_files(spark, str(tmp_path), TARGET)
        ids = got.records.select(F.try_variant_get("record", "$.id", "long").alias("id"))
        assert ids.agg(F.count_distinct("id"), F.sum("id")).first()[:] == (n, n * (n - 1) // 2)
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert [(r.status, r.records_converted) for r in got.status.collect()] == [("SUCCESS", n)]


def test_names_and_skipped_files(spark, tmp_path):
    inside = tmp_path / "raw" / "batch" / "inventory-raw"
    inside.mkdir(parents=True)
    (inside / "done.json").write_text('{"a":1}')
    (tmp_path / "stock a+b.json").write_text('[{"inventory_id":1},{"inventory_id":"2"}]')
    records, status, got = read(spark, tmp_path, processing_date="2025-07-20")
    assert status["done.json"].status == "skipped" and "done.json" not in records
    stock = next(r for r in status.values() if r.status == "SUCCESS")
    assert stock.output_location == TARGET + "output_name=2025-07-20_stock a+b.json"
    out = str(tmp_path / "out")
    write_json_lines(got, out)
    back = scan_inventory_raw(spark, out)
    assert sorted(r.inventory_id for r in back.collect()) == ["1", "2"]


def manifest(tmp_path, *entries):
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps({"entries": [dict(zip(("url", "mandatory"), e)) for e in entries]}, indent=2))
    return str(path)


def test_manifest(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    for name in ("a", "b", "c"):
        (data / name).write_text(f"{name}1\n{name}2\n")
    listed = manifest(
        tmp_path, (f"file://{data}/a", True), (str(data / "b"), False), (str(data / "gone"), False)
    )
    got = sorted(r.value for r in manifest_scan(spark, listed, str(data)).collect())
    assert got == ["a1", "a2", "b1", "b2"]
    broken = manifest(tmp_path, (str(data / "a"), True), (str(data / "gone"), True))
    with pytest.raises(FileNotFoundError, match="gone"):
        manifest_scan(spark, broken, str(data))
