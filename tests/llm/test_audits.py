"""Filter audit, vector codes and line dedup against plain computations."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import filter_audit, line_dedup, vector_codes
from shelfline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# --- filter audit


def plain_failures(rows):
    """Per row the letters of the filters that it fails."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    found = []
    for doc_id, text, _ in rows:
        t = text or ""
        w = WORD.findall(t)
        bad = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": doc_id is not None and doc_id > least[t],
        }
        found.append({k for k, v in bad.items() if v})
    return found


def plain_audit(rows, labels):
    """Every order run filter by filter over the rows."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    fails, parts = plain_failures(rows), defaultdict(list)
    for n, (_, _, lang) in enumerate(rows):
        parts[lang or ""].append(n)
    out = {}
    for part, members in parts.items():
        shares = Counter()
        for order in permutations("ABCDE"):
            left = set(members)
            for step, f in enumerate(order, 1):
                gone = {n for n in left if f in fails[n]}
                left -= gone
                shares[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(f in fails[n] for n in members) - len(gone),
                    sum(fails[n] == {f} for n in members),
                    sum(rows[n][0] in good for n in gone),
                    sum(rows[n][0] in toxic for n in gone),
                ]
        for (p, order, step), numbers in out.items():
            if p == part:
                numbers.append(shares[order[step - 1]])
    return out


def audited(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    assert len(rows) == len({(r.part, r.filter_order, r.step) for r in rows})
    return {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in rows}


def odd_documents():
    many = " ".join(f"w{i}" for i in range(220))
    texts = [None, "", many, many, many.upper(), many + " #", "tell " * 250, "TELL | " * 250, "É" * 900, " \t\n", "Ab cd"]
    rows = [(i, t, lang) for i, t in enumerate(texts) for lang in ("en", None)]
    rows += [(i + 100, t, "de") for i, t in enumerate(texts)]
    rows += [(None, many, "en"), (None, many, "en"), (-5, many, ""), (2, many, "en"), (2, many, "fr"), (7, "x", "de")]
    return rows + [(900, "long " * 400_000, "fr"), (901, " ".join(map(str, range(150_000))), "fr")]


LABELS = [(0, 1, 0), (0, 0, 1), (2, 1, None), (2, 1, 1), (3, None, 1), (7, 1, 1), (102, 1, 0), (104, 0, 0), (None, 1, 1), (555, 1, 1)]


def test_filter_audit_of_odd_rows(spark):
    rows = odd_documents()
    random.Random(3).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    docs = docs.withColumns({"n": F.lit(1), "mask": F.lit("x"), "good": F.lit(7), "part": F.lit(0)})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("text", F.lit(1))
    assert audited(filter_audit.filter_audit(docs, labels)) == plain_audit(rows, LABELS)


def test_filter_audit_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    found = audited(QUERIES["op11_filter_audit"](spark, SF))
    assert found == plain_audit(rows, labels)
    assert any(n[2] for n in found.values()) and any(n[3] for n in found.values())


def test_filter_audit_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(none, no_labels).count() == 0
    one = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")
    assert audited(filter_audit.filter_audit(one, no_labels)) == plain_audit([(1, "a", None)], [])


def test_survivors_of_every_subset():
    rng = np.random.default_rng(5)
    masks, counts = np.arange(32), rng.integers(0, 9, (32, 3))
    states = filter_audit.survivors(masks, counts)
    for subset in range(32):
        assert (states[subset] == counts[masks & subset == 0].sum(axis=0)).all()


# --- vector codes


def plain_codes(vectors, rounds=4):
    """(codes, errors, digest) of a full search, given integer vectors in order of their ids."""
    d = len(vectors[0])
    parts, books = [], []
    for k in range(4):
        x = np.array([v[k * d // 4 : (k + 1) * d // 4] for v in vectors], object).reshape(len(vectors), -1)
        parts.append(x)
        books.append(x[:256].copy())

    def assigned(x, book):
        return [min((int(((v - c) ** 2).sum()), e) for e, c in enumerate(book)) for v in x]

    for _ in range(rounds):
        for x, book in zip(parts, books):
            own = defaultdict(list)
            for v, (_, e) in zip(x, assigned(x, book)):
                own[e].append(v)
            for e, members in own.items():
                book[e] = [sum(c) // len(members) for c in zip(*members)]
    last = [assigned(x, book) for x, book in zip(parts, books)]
    codes = ["".join(f"{e:02x}" for _, e in found) for found in zip(*last)]
    errors = [sum(dist for dist, _ in found) for found in zip(*last)]
    text = ",".join(str(c) for b in books for row in b for c in row)
    return codes, errors, hashlib.sha256(text.encode()).hexdigest()


def whole(v):
    return [int(np.floor(1024 * float(x))) for x in v]


def check_codes(found, rows):
    """``rows`` (vec_id, vector, label) that are kept, ids distinct."""
    rows = sorted(rows)
    codes, errors, digest = plain_codes([whole(v) for _, v, _ in rows])
    sums = Counter()
    for (_, _, label), error in zip(rows, errors):
        sums[label] += error
    wanted = {i: (c, e, sums[label], digest) for (i, _, label), c, e in zip(rows, codes, errors)}
    assert {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in found} == wanted


def test_vector_codes_with_copies_and_clusters(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(5, 16))
    rows = [(i, (centres[i % 5] + rng.normal(size=16) * 0.2).tolist(), int(i % 4) or None) for i in range(0, 700, 2)]
    rows += [(i, rows[0][1], 9) for i in range(1, 300, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    clash = df.withColumns({"v": F.lit(1), "code": F.lit(2), "error": F.lit("x"), "entry": F.lit(0), "of": F.lit(1)})
    check_codes(vector_codes.compress(clash).collect(), rows)


def test_vector_codes_of_odd_vectors(spark):
    whole_ones = [(3, [0.5, -0.25, 1e-9, -1e-9, 3.0], None), (1, [0.0] * 5, 1), (2, [-2.0, 7.0, 0.0, 0.0, 90_000.0], 1)]
    odd = [(4, None, 1), (5, [float("nan")] + [0.0] * 4, 1), (6, [float("-inf")] * 5, 1), (7, [None, 1.0, 1.0, 1.0, 1.0], 1), (8, [1.0, 2.0], 1), (9, [], 2)]
    df = spark.createDataFrame(whole_ones + odd, "vec_id long, embedding array<float>, label int")
    check_codes(vector_codes.compress(df).collect(), whole_ones)
    huge = spark.createDataFrame([(1, [3e38, -3e38, 0.0, 1.0], 0), (None, [-3e38, 3e38, 1.0, 1.0], 0), (1, [0.0] * 4, None)], "vec_id long, embedding array<float>, label int")
    assert [r.error for r in vector_codes.compress(huge).collect()] == [0, 0, 0]
    for schema in ("vec_id long, embedding array<float>, label int", "vec_id string, embedding array<double>, label string"):
        assert vector_codes.compress(spark.createDataFrame([], schema)).count() == 0
    empty = spark.createDataFrame([(1, [], 0), (2, [], 0)], "vec_id long, embedding array<float>, label int")
    assert {(r.code, r.error) for r in vector_codes.compress(empty).collect()} == {("00000000", 0)}


def test_repeated_vectors_keep_their_rows(spark):
    rows = [(1, [0.1, 0.2, 0.3, 0.4], 1)] * 3 + [(1, [0.9, 0.2, 0.3, 0.4], 1), (2, [0.1, 0.2, 0.3, 0.4], None)] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = vector_codes.compress(df).collect()
    assert len(found) == 7 and {r.error for r in found} == {0} and len({r.code for r in found}) == 2


def test_vector_codes_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    check_codes(QUERIES["op12_vector_codes"](spark, SF).collect(), rows)


@pytest.mark.parametrize("side, most, at_once", [(1, 10, 40), (32, 50_000, 1 << 18), (64, 3, 300), (5000, 2, 1)])
def test_grid_finds_what_a_full_search_finds(side, most, at_once):
    rng = np.random.default_rng(11)
    book = rng.integers(-300, 300, (40, 6))
    book[7] = book[3]
    x = np.concatenate([rng.integers(-400, 400, (300, 6)), np.repeat(book[[3, 7, 9]], 50, axis=0), [[2**26] * 6, [-(2**26)] * 6]])
    grid = vector_codes.Grid(book, side, most, at_once)
    for _ in range(2):
        entry, error = grid.nearest(x)
        apart = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        assert (entry == apart.argmin(axis=1)).all() and (error == apart.min(axis=1)).all()
    assert len(grid.memory) <= max(most, at_once // 40, 1)


def test_grid_evaluates_few_entries():
    rng = np.random.default_rng(13)
    book = rng.integers(-300, 300, (200, 8))
    grid = vector_codes.Grid(book, 16)
    grid.nearest(book[:50] + rng.integers(-9, 9, (50, 8)))
    assert np.mean([len(e) for e in grid.memory.values()]) < 20


# --- line dedup


def line_key(line):
    return line.strip(WHITE).translate(LOWER)


def plain_lines(rows, least):
    held = Counter(k for _, t in rows for k in {line_key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if not line_key(x) or held[line_key(x)] < least]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def odd_lines():
    rows = [(i, f"own {i}\nShared Line\n\n  shared line\t\r\nÉcole {i % 3}\nend") for i in range(9)]
    rows += [(20, None), (21, ""), (None, "SHARED LINE"), (None, "SHARED LINE"), (None, "école 1"), (22, "\n\n"), (23, " \x0b\x0c "), (23, " end")]
    return rows + [(24, "end\nEnd \nEND"), (25, "\n".join(f"{i}" if i % 3 else "end" for i in range(60_000))), (26, "x" * 3_000_000 + "\nend")]


@pytest.mark.parametrize("least", [1, 3, 10, 12, 50])
def test_line_dedup_of_odd_texts(spark, least):
    rows = odd_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs = docs.withColumns({"key": F.lit(1), "at": F.lit(2), "_text": F.lit(3), "h1": F.lit(4), "n_lines": F.lit(5), "t1": F.lit(0)})
    found = line_dedup.drop_shared_lines(docs, min_documents=least).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_lines(rows, least)


def test_lines_need_their_length(spark):
    docs = spark.createDataFrame([(i, "ab\nabcd") for i in range(3)], "doc_id int, text string")
    found = line_dedup.drop_shared_lines(docs, min_documents=2, min_chars=3).collect()
    assert {(r.n_dropped, r.text) for r in found} == {(1, "ab")}


def test_line_dedup_of_an_empty_table(spark):
    assert line_dedup.drop_shared_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_dedup_plan_is_native(spark, capsys):
    QUERIES["op13_line_dedup"](spark, SF).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
