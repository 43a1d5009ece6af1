"""Near-duplicates, mixing, archives, token files, neighbours and the pipeline."""

import base64
import gzip
import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shelfline.config import new_shared_path
from shelfline.llm import mixing, near_duplicates, neighbours, token_files, warc
from shelfline.llm.common import repeated, row_key
from shelfline.llm.components import components
from shelfline.llm.queries import QUERIES
from shelfline.llm.token_files import EliasFano

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1)))


def plain_components(rows, size, percent=80):
    """{row place: (set size, smallest id reachable)}"""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return [(rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows))]


def made_texts():
    """Chains of near copies, exact copies, shared passages, and odd texts."""
    random.seed(4)
    words = lambda n: [f"w{random.randint(0, 5000)}" for _ in range(n)]
    rows = [(900, None), (901, ""), (902, " \n"), (903, "two words"), (904, "Two  WORDS"), (905, "two words"), (905, "two words"), (None, "two words")]
    passage = words(40)
    for i in range(30):
        rows.append((100 + i, " ".join(words(60) + passage)))
    text = words(120)
    for i in range(40):  # each step changes a word: the ends of the chain are unlike
        rows.append((300 - i, " ".join(text)))
        text = text[:]
        text[random.randrange(len(text))] = f"new{i}"
    original = words(200)
    for i in range(60):
        copy = original[:]
        for _ in range(random.randint(0, 4)):
            copy[random.randrange(200)] = f"x{random.randint(0, 99)}"
        rows.append((500 + i, " ".join(copy)))
    rows += [(600 + i, " ".join(original)) for i in range(25)]
    rows.append((7, "x " * 20_000))
    return rows


def key(row):
    return tuple((v is None, v or 0) for v in row)


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(spark, size):
    rows = made_texts()
    docs = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, n int, node string")
    found = near_duplicates.near_duplicates(docs, shingle=size).collect()
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found]
    assert sorted(got, key=key) == sorted(plain_components(rows, size), key=key)
    firsts = Counter(r["component_id"] for r in found if r["first"] and r["n_shingles"])
    assert set(firsts.values()) == {1}


def test_near_duplicates_of_the_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op10_near_duplicates"](spark, SF).collect()
    assert sorted(tuple(r)[:3] for r in found) == sorted(plain_components(rows, 4))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_every_candidate_is_settled_without_star_rounds(spark):
    rows = made_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates.near_duplicates(docs, shingle=4, star_rounds=0)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()]
    assert sorted(got, key=key) == sorted(plain_components(rows, 4), key=key)
    assert near_duplicates.near_duplicates(docs.limit(0)).collect() == []


def alike_texts(texts=160, words=120, changed=14):
    """Texts that share one base, each with own words at random places: most pairs are below 0.8."""
    r = random.Random(9)
    base = [f"base{i}" for i in range(words)]
    rows = []
    for n in range(texts):
        own = list(base)
        for at in r.sample(range(words), r.randint(0, changed) if n % 4 else 1):
            own[at] = f"own{n}x{at}" if n % 3 else f"often{at}"
        rows.append((n, " ".join(own)))
    return rows + [(1000 + n, f"{t} and more words at the end {n}") for n, t in rows[::5]]


@pytest.mark.parametrize("star_rounds", [0, 1])
def test_groups_of_texts_that_are_alike_but_not_enough(spark, star_rounds, monkeypatch):
    rows = alike_texts()
    made, linked = [], near_duplicates.linked

    def counted(pairs, sets, percent):
        made.append(pairs.count())
        return linked(pairs, sets, percent)

    monkeypatch.setattr(near_duplicates, "linked", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates.near_duplicates(docs, shingle=3, star_rounds=star_rounds).collect()
    wanted = plain_components(rows, 3)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(wanted)
    # Both linked and other texts abound, and few pairs are compared.
    assert 20 < len({c for _, _, c in wanted}) < len(rows) - 20
    assert sum(made) < len(rows) ** 2 / 20


def test_texts_that_share_an_id_meet_their_own_class_only(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[:k] + ["x"] + words[k + 1 :])) for i in (None, 7) for k in range(0, 60, 3)]
    rows = [(i, f"{t} {i}") for i, t in rows]
    met, sets = spark.sparkContext.accumulator(0), near_duplicates._sets

    def counted(size):
        inner = sets(size)

        def run(batches):
            for pdf in batches:
                met.add(len(pdf))
                yield from inner(iter([pdf]))

        return run

    monkeypatch.setattr(near_duplicates, "_sets", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates.near_duplicates(docs, shingle=4)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()]
    assert sorted(got, key=key) == sorted(plain_components(rows, 4), key=key)
    assert 0 < met.value <= len(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 103), (103, 101), (101, 101), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {100: 100, 101: 100, 103: 100, 200: 200, 201: 200}


# --- mixing ------------------------------------------------------------------------------


def plain_targets(sizes, weights=(3, 1, 2)):
    """Reshare the excess until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    want, open_now = {}, set(names)
    rest = 1.5 * sum(sizes.values())
    while open_now:
        level = rest / sum(weight[s] for s in open_now)
        full = {s for s in open_now if level * weight[s] > 2 * sizes[s]}
        if not full:
            return want | {s: level * weight[s] for s in open_now}
        want |= {s: 2.0 * sizes[s] for s in full}
        rest -= sum(2 * sizes[s] for s in full)
        open_now -= full
    return want


@pytest.mark.parametrize("bins", [1, 8, 65_536])
def test_mixing(spark, bins):
    random.seed(9)
    rows = []
    for i in range(400):
        source = random.choice(["a", "b", "B", "é", None, "zero"])
        n = 0 if source == "zero" else random.randint(0, 60)
        rows.append((i, " ".join(["w"] * n) if n or i % 2 else None, source, "clash"))
    rows += [(5, "w w w", "a", "repeated")] * 3 + [(None, "no id", "a", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    found = mixing.mix(docs, bins=bins).collect()
    sizes = Counter({s: 0 for s in ("a", "b", "B", "é", None, "zero")})
    for _, t, s, _ in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = plain_targets(sizes)
    taken, longest = Counter(), Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and r["taken"] <= 2 * r["size"]
        epochs = int(want[r["source"]] / sizes[r["source"]] + 1e-9) if sizes[r["source"]] else 0
        assert r["size"] == 0 or r["copies"] in (epochs, epochs + 1)
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    assert len(found) == len(rows)
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6 for s in sizes)
    again = mixing.mix(docs.repartition(3), bins=bins).collect()
    as_rows = lambda rs: sorted(str((r["doc_id"], r["source"], r["size"], r["taken"])) for r in rs)
    assert as_rows(found) == as_rows(again)
    assert mixing.mix(docs.limit(0)).collect() == []


def test_mixing_prefers_quality(spark):
    rows = [(i, ("good words " if i % 2 else "## 12 ") * 10, "s") for i in range(2000)]
    rows += [(10_000 + i, "w " * 100, "t") for i in range(300)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 40))
    by = {r[0]: r[1] for r in found.filter("source = 's'").groupBy((F.col("doc_id") % 2).alias("g")).agg(F.avg("copies")).collect()}
    assert by[1] > by[0]


def test_mixing_prefers_texts_that_do_not_repeat_themselves(spark):
    rows = [(i, " ".join(f"w{k if i % 2 else k % 3}" for k in range(20)), "s") for i in range(2000)]
    rows += [(10_000 + i, "w " * 100, "t") for i in range(300)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 40))
    by = {r[0]: r[1] for r in found.filter("source = 's'").groupBy((F.col("doc_id") % 2).alias("g")).agg(F.avg("copies")).collect()}
    assert by[1] > by[0]


def test_rows_without_an_id_spread_over_the_keys(spark):
    docs = spark.createDataFrame([(None, f"text number {i}", "s") for i in range(500)], "doc_id long, text string, source string")
    keys = docs.select(mixing.uniform(F.col("doc_id"), F.col("text"), 7).alias("u")).distinct()
    assert keys.count() == 500


def test_verdicts_reach_the_row_they_are_about(spark):
    """One id and text in two sources: each row as often as its own verdict says."""
    rows = [(i, f"words of {i}", s) for i in range(40) for s in ("a", "b")] + [(7, "same", None)] * 2500 + [(None, None, "a")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    times = F.when(F.col("source") == "a", 2).when(F.col("text") == "same", 1).otherwise(0)
    verdicts = docs.select("doc_id", row_key(docs).alias("row_key"), times.alias("times"))
    found = Counter(tuple(r) for r in repeated(docs.repartition(3), verdicts).collect())
    assert found == {**{(i, f"words of {i}", "a"): 2 for i in range(40)}, (7, "same", None): 2500, (None, None, "a"): 6}
    assert repeated(docs.limit(0), verdicts.limit(0)).collect() == []


def test_mixed_table_keeps_to_the_targets_of_repeated_ids(spark):
    rows = [(i, f"five words stand in {i}", s) for i in range(300) for s in ("a", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r.source: r.taken for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    mixed = {r.source: 5 * r["count"] for r in corpus_pipeline.mix_sources(spark, docs, "").groupBy("source").count().collect()}
    assert mixed == taken and taken["a"] > taken["b"]


# --- archives ----------------------------------------------------------------------------

PAGES = [
    (1, "http://a/", "same"), (2, "http://b/", "same"), (3, "http://c/ d\r\ne", "same"),
    (4, None, None), (5, "u", ""), (6, "u", "é 日本 \r\n\r\nWARC/1.1\r\n fake"), (7, "u", "z" * 300_000),
    (8, "u", "dup"), (8, "u", "dup"), (None, "u", "no id"), (9, "u", "\x1f\x8b\x08 not gzip"),
]


def plain_archive(pages, least=0):
    by = defaultdict(list)
    for i, _, html in pages:
        by[html or ""].append(i)
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        top = max((x for x in by[html or ""] if x is not None), default=None)
        revisit = len(data) >= least and i != top
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", top if revisit else None))
    return out


def as_rows(records):
    number = lambda v: None if v is None else int(v)
    return [(number(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"])) for r in records]


@pytest.mark.parametrize("least", [0, 4])
def test_archive_round_trip(spark, least):
    path = new_shared_path(spark, "warc-test")
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, size string")
    warc.write(pages, path, min_payload=least, records_per_file=3)
    records, gaps = warc.read(spark, path)
    found = records.collect()
    assert sorted(as_rows(found), key=key_of) == sorted(plain_archive(PAGES, least), key=key_of)
    payloads = {bytes(r["payload"]).decode() for r in found if r["record_type"] == "response"}
    assert payloads == {html or "" for _, _, html in PAGES}
    assert gaps.collect() == []


def key_of(row):
    return tuple(str(v) for v in row)


def test_archive_round_trip_of_long_urls(spark):
    path = new_shared_path(spark, "warc-test")
    long = "data:," + "x" * 200_000
    rows = [(1, long, "same"), (2, long, "same"), (3, "u", "other")]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    records, gaps = warc.read(spark, path)
    assert sorted(as_rows(records.collect()), key=key_of) == sorted(plain_archive(rows), key=key_of)
    assert gaps.collect() == []


def test_headers_end_before_the_next_version_line():
    lost = make_record(1, b"")[:-6]  # without its blank lines
    assert salvaged(lost + make_record(2, b"x")) == ([2], [(0, len(lost), "headers do not end")])


def test_a_gap_fails_the_archive_query(spark, monkeypatch):
    damaged = spark.createDataFrame([("damaged",)], "value string")
    monkeypatch.setattr(warc, "write", lambda pages, path: damaged.write.text(path))
    with pytest.raises(Exception, match="no version line"):
        QUERIES["op4_warc"](spark, SF).collect()


def test_empty_archive(spark):
    path = new_shared_path(spark, "warc-test")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    records, gaps = warc.read(spark, path)
    assert records.collect() == [] and gaps.collect() == []


def test_archive_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, QUERIES["op4_warc"](spark, SF).collect()), key=key_of) == sorted(plain_archive(pages), key=key_of)


def make_record(i, payload):
    return warc.record("response", str(i), f"http://x/{i}", warc.digest32(payload), len(payload), payload, None)


def salvaged(data):
    found = list(warc.salvage(data))
    return [int(re.search(r"\d+", f[1]["warc-record-id"])[0]) for f in found if f[0] == "record"], [f[1:] for f in found if f[0] == "gap"]


def test_salvage_of_gzip_members():
    random.seed(2)
    members = [warc.member(make_record(i, random.randbytes(2000) + b"\x1f\x8b\x08")) for i in range(20)]
    starts = np.cumsum([0] + [len(m) for m in members]).tolist()
    whole = b"".join(members)
    assert salvaged(whole) == (list(range(20)), [])
    damaged = bytearray(whole)
    damaged[starts[3] + 200] ^= 255  # inside a member
    damaged[starts[8]] = 0  # its magic
    damaged = bytes(damaged[: starts[12]]) + b"garbage" * 9 + bytes(damaged[starts[12] : starts[19] + 50])
    ids, gaps = salvaged(damaged)
    assert ids == [i for i in range(19) if i not in (3, 8)]
    assert [g[:2] for g in gaps] == [(starts[3], starts[4]), (starts[8], starts[9]), (starts[12], starts[12] + 63), (starts[19] + 63, len(damaged))]
    assert all(g[2] for g in gaps)
    assert salvaged(b"\x00" + whole)[0] == list(range(20))


def test_salvage_of_plain_records():
    records = [make_record(i, b"payload %d WARC/1.1 " % i * 5) for i in range(10)]
    starts = np.cumsum([0] + [len(r) for r in records]).tolist()
    damaged = bytearray(b"".join(records))
    damaged[starts[4] + len(records[4]) - 20] ^= 1  # the digest differs
    at = damaged.index(b"Content-Length", starts[7])
    damaged[at : at + 17] = b"Content-Length: x"
    ids, gaps = salvaged(bytes(damaged))
    assert ids == [0, 1, 2, 3, 5, 6, 8, 9]
    assert [g[:2] for g in gaps] == [(starts[4], starts[5]), (starts[7], starts[8])]
    assert salvaged(bytes(damaged[: starts[9] + 30]))[0] == [0, 1, 2, 3, 5, 6, 8]
    assert salvaged(b"") == ([], []) and salvaged(b"noise")[1][0][:2] == (0, 5)


@pytest.mark.parametrize("stored", [False, True])
def test_salvage_inside_of_a_member(stored):
    random.seed(4)
    level = 0 if stored else 6
    records = [make_record(i, random.randbytes(300).hex().encode()) for i in range(20)]
    whole = gzip.compress(b"".join(records), level, mtime=0)
    assert salvaged(whole) == (list(range(20)), [])
    bad = records[7].replace(b"sha1:", b"sha1:x")
    one_bad = gzip.compress(b"".join([*records[:7], bad, *records[8:]]), level, mtime=0)
    ids, gaps = salvaged(one_bad)
    assert ids == [i for i in range(20) if i != 7]
    start = sum(map(len, records[:7]))
    place = f"bytes {start} to {start + len(bad)} of the member's content"
    assert gaps == [(0, len(one_bad), f"block digest differs, {place}")]
    # A cut tail, at the end of the file and before another member.
    for keep in (len(whole) * 3 // 4, len(whole) - 4):
        for tail in (b"", warc.member(make_record(99, b"later"))):
            ids, gaps = salvaged(whole[:keep] + tail)
            n = len([i for i in ids if i < 99])
            assert ids == list(range(n)) + [99] * bool(tail) and n >= (14 if keep < len(whole) - 4 else 20)
            assert (0, keep) in [g[:2] for g in gaps]
    # Damage that zlib meets midway.
    broken = bytearray(whole)
    broken[len(whole) // 2 : len(whole) // 2 + 40] = b"\xff" * 40
    ids, gaps = salvaged(bytes(broken))
    assert ids[:9] == list(range(9)) and len(ids) == len(set(ids)) < 20 and gaps


def test_salvage_tells_the_form_at_each_position():
    packed = gzip.compress(b"payload " * 50, mtime=0)
    plain = [make_record(i, packed) for i in range(4)]
    lost = len(plain[0])
    assert salvaged(b"XXXX" + b"".join(plain)[4:])[0] == [1, 2, 3]
    assert salvaged(b"XXXX" + b"".join(plain)[4:])[1][0][:2] == (0, lost)
    mixed = plain[0] + warc.member(make_record(5, b"x")) + b"noise" + plain[1]
    assert salvaged(mixed) == ([0, 5, 1], [(len(mixed) - lost - 5, len(mixed) - lost, "no version line")])


def test_members_end_in_zero():
    assert warc.member(b"x")[-1] == 0
    big = warc.member(b"\0" * (17 << 20))
    assert big[-1] == 0 and len(gzip.decompress(big)) == 17 << 20


# --- token files -------------------------------------------------------------------------


def test_elias_fano():
    random.seed(3)
    for n, u in ((0, 0), (1, 0), (1, 10**12), (1000, 1000), (5000, 10**9), (3000, 20), (700, 2**40)):
        values = np.sort(np.array([random.randint(0, u) for _ in range(n)], dtype=np.uint64))
        block = EliasFano.pack(values, u)
        code = EliasFano(b"pad" + block, 3)
        assert code.end == 3 + len(block)
        assert [code[i] for i in range(0, n, 7)] == values[::7].tolist()
        assert code.all().tolist() == values.tolist()
        if n > 500:
            assert len(block) * 8 < n * (3 + max(np.log2(u / n), 0)) + 300


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_files(rows, tokenizer):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


ODD = [
    (3, "a b"), (-5, "minus"), (2**60, "large id"), (7, None), (8, ""), (9, " lead  double\n next 　x\xa0 y "),
    (10, "日本 😀 <|endoftext|> it's"), (11, "long " * 20_000), (12, "zz" * 4000), (None, "no id"), (13, "same"), (14, "same"),
    (15, "a<|endoftext|>b"), (16, "two  <|endoftext|>  more\n<|endoftext|>\n\n end<|endoftext|>."), (17, "<|endoftext"),
]


def test_token_files(spark, tokenizer):
    path = new_shared_path(spark, "token-test")
    docs = spark.createDataFrame([(i, t, 1) for i, t in ODD], "doc_id long, text string, start int")
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        text = file.read()
    token_files.write(docs, path, text, ids_per_file=100)
    assert sorted(map(tuple, token_files.read(spark, path).collect()), key=lambda r: r[1]) == plain_files(ODD, tokenizer)
    opened = [token_files.TokenFile(bytes(r["content"])) for r in spark.read.format("binaryFile").load(path).collect()]
    assert len(opened) > 2 and sum(f.documents for f in opened) == len(ODD)
    texts = {i: t for i, t in ODD}
    for f in opened:
        for k, i in enumerate(f.doc_ids()):
            assert f.ids(k).tolist() == tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [0]
    empty = new_shared_path(spark, "token-test")
    token_files.write(docs.limit(0), empty, text)
    assert token_files.read(spark, empty).collect() == []


def test_token_file_query(spark, tokenizer):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op6_token_files"](spark, SF).collect())) == plain_files(rows, tokenizer)


# --- neighbours --------------------------------------------------------------------------


def plain_nearest(rows, k, is_query):
    best = {}
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    for qi, q in good:
        if is_query(qi):
            near = {}
            for i, v in good:
                if i != qi and len(v) == len(q):
                    near[i] = max(near.get(i, -np.inf), float((q * v).sum()))
            best.setdefault(qi, sorted(near.items(), key=lambda x: (-x[1], x[0]))[:k])
    return best


def test_neighbours_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = plain_nearest(rows, 20, lambda i: i % 20 == 0)
    got = defaultdict(list)
    for r in sorted(QUERIES["op9_neighbours"](spark, "/root/testdata/sf0.1").collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    vectors = dict(rows)
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0])) and q not in dict(found) and len(found) == 20
        assert all(s == pytest.approx(float(np.dot(np.array(vectors[q], float), np.array(vectors[i], float)))) for i, s in found)
    assert got.keys() == want.keys()
    recall = np.mean([len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 20 for q in want])
    assert recall >= 0.9


@pytest.mark.parametrize("sigma, copies", [(0, True), (0.5, False), (1, False), (0.5, True)])
def test_neighbours_recall_with_lengths_and_copies(spark, sigma, copies):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((8192, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x *= rng.lognormal(0, sigma, 8192)[:, None]
    x[rng.permutation(8192)[: 8192 // 3 * copies]] = x[0]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    scores = defaultdict(list)
    for r in neighbours.nearest(vectors, lambda i: i % 64 == 0).collect():
        scores[r["query_id"]].append(r["score"])
    recall = []
    for i in range(0, 8192, 64):
        least = np.sort(np.delete(x @ x[i], i))[-20]
        recall.append(sum(s >= least - 1e-9 for s in scores[i]) / 20)
    assert np.mean(recall) >= 0.95


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (None, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (9, [-1.0, 0.0])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    for block in (8192, 2):
        found = neighbours.nearest(vectors, lambda i: i % 20 == 0, k=3, block=block).collect()
        got = {q: [(r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 20, 40)}
        want = {q: v[:3] for q, v in plain_nearest(rows, 3, lambda i: i % 20 == 0).items()}
        assert got == want
    assert neighbours.nearest(vectors.limit(0), lambda i: i % 20 == 0).collect() == []


# --- pipeline ----------------------------------------------------------------------------


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = new_shared_path(spark, f"test-{name}")
        stage(spark, tables[-1], SF).write.parquet(path)
        tables.append(spark.read.parquet(path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert tables[-1].columns == columns
    start, mild, single, clean, mixed, tokens = ([tuple(r) for r in t.collect()] for t in tables)
    scored = {r["doc_id"]: r["predicted"] for r in QUERIES["op5_toxicity"](spark, SF).collect()}
    assert sorted(mild) == sorted(r for r in start if not scored[r[0]])
    groups = plain_components([r[:2] for r in mild], 5)
    assert sorted(r[0] for r in single) == sorted({c for _, n, c in groups if n} | {i for i, n, _ in groups if not n})
    assert set(single) <= set(mild)
    assert sorted(r[0] for r in clean) == sorted(r[0] for r in single)
    assert not any(re.search(r"[0-9a-f]{16}|AKIA[A-Z0-9]{14}", r[1] or "") for r in clean)
    assert [r for r in sorted(clean) if "[SECRET]" not in r[1]] == [r for r in sorted(single) if r in set(clean)]
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(tables[3]).collect()}
    assert Counter(r[0] for r in mixed) == Counter({i: c for i, c in taken.items() if c})
    assert len(tokens) == len(mixed)
    want = hashlib.sha256
    texts = {r[0]: r[1] for r in mixed}
    assert all(t[4] == want(texts[t[0]].encode()).hexdigest() and len(t[5]) == t[2] for t in tokens)


def test_pipeline_stages_of_odd_rows(spark, tmp_path):
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, None, None, None, None), (3, "", "en", "s", 0),
            (None, "token = abcdefghijklmnop", "en", None, 24), (4, "A B  c d e f", "en", "t", 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    counts = []
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), stage(spark, docs, str(tmp_path)).schema)
        counts.append(docs.count())
    assert counts[:3] == [6, 4, 4]
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).collect() == []
