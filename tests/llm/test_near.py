"""Near duplicates, components and the segment index against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import components, near, segments
from millrace.llm.shingles import class_id, words_of

R = random.Random(5)
WORDS = [f"w{i}" for i in range(400)]


def runs(t):
    w = words_of(t)
    return set(zip(w, w[1:], w[2:], strict=False))


def share(a, b):
    x, y = runs(a), runs(b)
    return len(x & y) / len(x | y) if x | y else 0.0


def edited(t, n):
    w = t.split()
    for _ in range(n):
        k = R.randrange(len(w))
        w[k : k + 1] = R.choice(([R.choice(WORDS)], [], [w[k], R.choice(WORDS)]))
    return " ".join(w)


def corpus():
    out = []
    for _ in range(60):
        base = " ".join(R.choices(WORDS, k=60))
        out += [base] + [edited(base, n) for n in (1, 3, 6, 9)]
    return out + [out[0], out[0].upper() + "!", None, "", "one two", "  "]


@pytest.mark.parametrize("hot", [near.HOT, 2])
def test_pairs(spark, hot):
    texts = corpus()
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {(r["a"], r["b"]) for r in near.similar_classes(df, 0.5, hot).collect()}
    by = {class_id(words_of(t)): t for t in texts if t and len(words_of(t)) > 2}
    want = {(min(a, b), max(a, b)) for a, b in combinations(by, 2) if share(by[a], by[b]) >= 0.5}
    assert got <= want and len(want) > 100
    # The guarantee is in the signatures' distance; of pairs at 0.5 some 1 % may differ too much, of those at 0.6 next to none.
    sure = {p for p in want if share(by[p[0]], by[p[1]]) >= 0.6}
    assert len(sure - got) <= 1 and len(got) >= 0.98 * len(want)


@pytest.mark.parametrize("hot", [near.HOT, 3])
def test_many_parts_and_crowds_find_the_same(spark, monkeypatch, hot):
    """Every text of a crowd shares symbols and keys with all others, so that they are spread and paired block by block."""
    base = " ".join(R.choices(WORDS, k=80))
    texts = corpus() + [edited(base, 1) for _ in range(90)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    one = {(r["a"], r["b"]) for r in near.similar_classes(df, 0.5).collect()}
    monkeypatch.setattr(near, "TEXTS_PER_PART", 60)
    monkeypatch.setattr(near, "SEEN", 10**6)
    codes, keys = near._crowds(df, len(texts), 7)
    assert len(codes) > 10 and len(keys) > 10
    assert {(r["a"], r["b"]) for r in near.similar_classes(df, 0.5, hot).collect()} == one and len(one) > 3000


def _pair_at(similarity, r):
    """Two texts of 60 to 140 runs whose similarity is as asked, but for rounding: a shared head and tails of their own."""
    n = r.randint(60, 140)
    shared = round(2 * n * similarity / (1 + similarity))
    word = lambda: f"v{r.randrange(10**6)}"
    head = [word() for _ in range(shared + 2)]
    return head + [word() for _ in range(n - shared)], head + [word() for _ in range(n - shared)]


@pytest.mark.parametrize("low", [0.5, 0.52, 0.54, 0.56, 0.58])
def test_recall_by_band(low):
    """Recall of the look-up and the sketch, and the part that the guarantee covers, in each band of similarity."""
    r = random.Random(11)
    pairs = [_pair_at(low + 0.02 * k / 800, r) for k in range(800)]
    a, b = near.signatures([p[0] for p in pairs]), near.signatures([p[1] for p in pairs])
    meet = np.zeros(len(pairs), bool)
    for c in range(near.CHUNKS):
        meet |= (near.chunk_keys(a, c) == near.chunk_keys(b, c)).any(axis=1)
    found = meet & near._close(near.sketches(a), near.sketches(b), near.SKETCH_BITS)
    sure = (a[:, : near.INDEXED] != b[:, : near.INDEXED]).sum(axis=1) <= near.RADIUS
    assert (meet | ~sure).all()
    assert found.mean() >= 0.96 and sure.mean() >= 0.76


def test_record_pairs_with_many_copies(spark):
    m = [(1, f"r{i:03d}", 101, "r000") for i in range(101)] + [(2, "x", 1, "x"), (3, "y", 2, "y"), (3, "z", 2, "y")]
    members = spark.createDataFrame(m, "id long, record_id string, copies long, first string")
    pairs = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    whole = {tuple(r) for r in near.record_pairs(pairs, members, None).collect()}
    assert len(whole) == 101 * 100 // 2 + 101 + 2 + 1
    star = {tuple(r) for r in near.record_pairs(pairs, members, 100).collect()}
    assert star < whole and star == {("r000", f"r{i:03d}") for i in range(1, 101)} | {("r000", "x"), ("x", "y"), ("x", "z"), ("y", "z")}
    assert {tuple(r) for r in near.record_pairs(pairs, members, 101).collect()} == whole


@pytest.mark.parametrize("copies", [100, 101])
def test_query_and_sql_agree_on_copies(spark, tmp_path, copies):
    import duckdb

    from millrace.llm import queries

    text = "red foxes answer to beta when no hares are left near the border"
    data = [(f"r{i:03d}", text, "it is so") for i in range(copies)] + [("s", text + " today", "it is so"), ("t", "quite another thing", "to tell of here"), ("u", "short", "one")]
    spark.createDataFrame(data, "record_id string, question string, answer string").write.parquet(f"{tmp_path}/records.parquet")
    got = sorted(tuple(r) for r in queries.p6_found(spark, str(tmp_path)).collect())
    c = duckdb.connect()
    c.sql(f"create view records as select * from '{tmp_path}/records.parquet/*.parquet'")
    assert got == sorted(c.sql(queries.oracle_sql()["p6_found"]).fetchall()) and len(got) == (100 * 99 // 2 + 100 if copies == 100 else 101)
    groups = queries.p6_groups(spark, str(tmp_path)).filter("copy_of = 'r000'").count()
    assert groups == copies


def test_pigeonhole_guarantee():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**16, (200, near.SYMBOLS), dtype=np.uint16)
    b = a.copy()
    for r in b:
        at = rng.choice(near.INDEXED, near.RADIUS, replace=False)
        r[at] ^= 1
    meet = np.zeros(200, bool)
    for c in range(near.CHUNKS):
        meet |= (near.chunk_keys(a, c) == near.chunk_keys(b, c)).any(axis=1)
    assert meet.all()


def test_nothing_to_pair(spark):
    df = spark.createDataFrame([(None,), ("a b c d",)], "text string")
    assert near.similar_classes(df, 0.5).count() == 0
    assert near.similar_classes(df.limit(0), 0.5).count() == 0
    assert near.class_ids(df.withColumn("k", F.lit(1)), "k", "text").count() == 1


def test_components(spark, rows):
    pairs = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (200, 200), (None, 3), (50, 40), (40, 45)]
    got = dict(rows(components.components(spark.createDataFrame(pairs, "a long, b long"))))
    assert {got[i] for i in range(31)} == {0} and got[100] == got[101] == 100 and got[50] == got[45] == 40 and 200 not in got
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _questions(n, seed):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        base = r.choices(WORDS[:60], k=r.randint(3, 20))
        out += [" ".join(base), " ".join(base[1:] + [r.choice(WORDS)]), " ".join(base[:-2]) if len(base) > 6 else " ".join(base)]
    return sorted({*out})


@pytest.mark.parametrize("salt", [segments.SALT_ROWS, 7])
def test_segments_lose_nothing(spark, tmp_path, monkeypatch, salt):
    monkeypatch.setattr(segments, "SALT_ROWS", salt)
    old, new = _questions(80, 1), _questions(30, 2) + _questions(20, 1)
    frame = lambda xs: spark.createDataFrame([(class_id(x.split()), x) for x in xs], "id long, key string")
    index = segments.SegmentIndex(spark, str(tmp_path / "i"), 0.55)
    index.create(frame(old[:100] + old[:3]))
    files = sorted((f, f.stat().st_mtime_ns) for f in (tmp_path / "i").rglob("*.parquet"))
    index.append(frame(old[100:]))
    again = segments.SegmentIndex(spark, str(tmp_path / "i"), 0.55)
    for x in (index, again):
        got = {(r["id"], r["other"]) for r in x.near(frame(new)).collect()}
        name = {class_id(x.split()): x for x in old + new}
        want = {(class_id(a.split()), class_id(b.split())) for a in new for b in old if a != b and share(a, b) >= 0.55}
        assert got == want and len(want) > 20 and all(share(name[a], name[b]) >= 0.55 for a, b in got)
    assert all(f.stat().st_mtime_ns == at for f, at in files)
    assert index.near(frame(["x"]).limit(0)).count() == 0
    index.close(delete=True)
    assert not (tmp_path / "i").exists()


def test_history_is_neither_shuffled_nor_made_again(spark, tmp_path):
    """A probe reads the stored segments and strings as they lie: no exchange stands above their scans, and no text is cut again."""
    frame = lambda xs: spark.createDataFrame([(class_id(x.split()), x) for x in xs], "id long, key string")
    index = segments.SegmentIndex(spark, str(tmp_path / "i"), 0.55)
    index.create(frame(_questions(80, 1)))
    batch = segments.durable(segments.strings(frame(_questions(10, 2))))
    index.append_strings(batch.limit(3))
    plan = index.near_strings(batch)._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda s: len(s) - len(s.lstrip(" :+-"))
    scans = [k for k, line in enumerate(plan) if "FileScan parquet" in line]
    assert len(scans) == 2
    for k in scans:
        above, at = [], depth(plan[k])
        for line in reversed(plan[:k]):
            if depth(line) < at:
                above.append(line)
                at = depth(line)
            if "SortMergeJoin" in line and depth(line) == at:
                break
        assert "SortMergeJoin" in above[-1] and not any("Exchange" in line or "MapInArrow" in line for line in above)
    index.close()


def test_index_without_tables(spark, tmp_path, monkeypatch):
    from pyspark.errors import AnalysisException

    def no_tables(*_, **__):
        raise AnalysisException("no warehouse")

    frame = lambda xs: spark.createDataFrame([(class_id(x.split()), x) for x in xs], "id long, key string")
    old, new = _questions(40, 1), _questions(20, 1)
    got = []
    for k in range(2):
        index = segments.SegmentIndex(spark, str(tmp_path / f"i{k}"), 0.55)
        if k:
            monkeypatch.setattr(type(spark), "sql", no_tables)
        index.create(frame(old[:60]))
        index.append(frame(old[60:]))
        got.append(sorted(tuple(r) for r in index.near(frame(new)).collect()))
        index.close(delete=True)
    assert got[0] == got[1] and got[0]
