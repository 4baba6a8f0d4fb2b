"""Archives, near duplicates, search, mixing, vector groups and the pipeline against brute force and on odd rows."""

import gzip
import hashlib
import io
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.tables import clashing, docs, odd, odd_rows, rows, sentence
from tickforge.llm import bbit_minhash as bb, common, mixing, projection_forest as forest, topk_search, warc
from tickforge.llm.common import prepare
from tickforge.llm.queries import ORACLE, QUERIES


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


def union_find(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    r = random.Random(1)
    pairs = {"path": [(i, i + 1) for i in range(40)], "star": [(7, i) for i in range(30) if i != 7],
             "random": [(r.randrange(60), r.randrange(60)) for _ in range(45)]}[shape]
    got = {x.node: x.component for x in common.components(spark.createDataFrame(pairs, "a int, b int"), "a", "b").collect()}
    want = union_find({n for p in pairs if p[0] != p[1] for n in p}, pairs)
    assert got == want


def test_running_sums_over_cells(spark):
    data = [(i % 3 or None, i, i % 7) for i in range(200)]
    df = spark.createDataFrame(data, "g int, k int, x int")
    for n in (1, 5):
        got = common.running(df, ["g"], ["k"], F.col("x"), n, "before").collect()
        for g in (None, 1, 2):
            at = sorted((x.before, x.before + x.x) for x in got if x.g == g)
            end = 0
            for a, b in at:
                assert a == end
                end = b


# -- archives

def page_rows():
    big, r = "<p>" + "x" * 200 + "</p>", random.Random(2)
    return [(1, "http://www.b.org/x?b=2&a=1", big), (2, "http://a.org/", big), (3, None, big), (4, "http://a.org/", "short"),
            (5, "http://a.org/", "short"), (6, "u\r\nX-Evil: 1", None), (None, "http://c.org", big), (7, "http://c.org", ""),
            (8, "http://é.org/ü", "ünïcode \U0001F600 " * 30), (8, "http://é.org/ü", "ünïcode \U0001F600 " * 30),
            (9, "http://[bad", "z" * 300_000), (10, "http://a.org/", sentence(r, 80) + "\r\n\r\nWARC/1.1")]


def pages(spark, data):
    return clashing(spark.createDataFrame(data, "page_id bigint, url string, body string"))


def test_archives_round_trip(spark):
    data = page_rows()
    got = warc.capture(pages(spark, data), html="body").collect()
    want = Counter()
    first = {}
    for i, _, t in data:
        b = (t or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    for i, _, t in data:
        b = (t or "").encode()
        to = first.get(b) if first.get(b) != i else None
        want[i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if to is not None else "response", to] += 1
    assert Counter((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in got) == want
    keys = [(x.url_key, x.captured, str(x.page_id) if x.page_id is not None else "") for x in got]
    assert keys == sorted(keys)
    assert warc.capture(pages(spark, []), html="body").collect() == []


def test_archives_are_plain_gzip_records(spark, tmp_path):
    folder = f"file://{tmp_path}/archives"
    files = warc.write(pages(spark, page_rows()), folder, html="body").collect()
    assert sum(f.records for f in files) == len(page_rows())
    text = b"".join(gzip.decompress((tmp_path / "archives" / f.file).read_bytes()) for f in files)
    assert text.count(b"WARC-Record-ID") == len(page_rows()) and b"\r\nX-Evil" not in text


def test_members_in_small_steps():
    parts = [b"a" * 10, b"", bytes(range(256)) * 50]
    data = b"".join(gzip.compress(p) for p in parts)
    for step in (1, 7, 1000, 1 << 20):
        found = list(warc.members(io.BytesIO(data), step))
        assert [p for _, _, p in found] == parts
        assert [gzip.decompress(data[o:o + n]) for o, n, _ in found] == parts
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(data[:-3]), 50))


def test_loser_tree():
    r = random.Random(3)
    for n in range(30):
        runs = [sorted(r.randrange(40) for _ in range(r.randrange(9))) for _ in range(n)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for run in runs for x in run)


def test_index_over_many_files_and_a_hot_url(spark, tmp_path, monkeypatch):
    data = [(i, "http://hot.org/" if i % 3 else f"http://s{i % 7}.org/{i}", sentence(random.Random(i), 30)) for i in range(300)]
    captured = F.format_string("2024-01-%02dT00:00:00Z", F.col("page_id") % 28 + 1)
    got = warc.capture(pages(spark, data).repartition(6), html="body", captured=captured).collect()
    keys = [(x.url_key, x.captured, str(x.page_id)) for x in got]
    assert len(got) == 300 and keys == sorted(keys) and len({x.file for x in got}) > 1


def test_url_key():
    assert warc.url_key("http://www.Example.com:80/A?b=2&a=1") == "com,example)/a?a=1&b=2"
    assert warc.url_key(None) == ")/" and warc.url_key("http://[x") == ")/http://[x"


# -- near duplicates

def shingles(text, n):
    w = (text or "").encode().lower().split()
    k = min(n, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute_groups(data, n, percent):
    sets = [(i, shingles(t, n)) for i, t, *_ in data]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a][1] and sets[b][1] and
             100 * len(sets[a][1] & sets[b][1]) >= percent * len(sets[a][1] | sets[b][1])]
    root = union_find(range(len(sets)), pairs)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        ids[root[k]].append(i)
    least = {r: min((i for i in members if i is not None), default=None) for r, members in ids.items()}
    return Counter((i, len(s), least[root[k]], least[root[k]] is None or i == least[root[k]]) for k, (i, s) in enumerate(sets))


def near_copies(seed, n_groups=6, size=14):
    r, out = random.Random(seed), []
    for _ in range(n_groups):
        base = [f"w{r.randrange(10_000)}" for _ in range(r.choice([40, 120, 400]))]
        for _ in range(size):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 5, len(base) // 30, len(base) // 15])):
                copy[r.randrange(len(copy))] = f"v{r.randrange(10_000)}"
            out.append(" ".join(copy))
    r.shuffle(out)
    return [(i, t) for i, t in enumerate(out)] + [(1000 + i, sentence(r, 4)) for i in range(30)]


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, words, percent):
    data = near_copies(words)
    got = Counter(tuple(x)[:4] for x in bb.groups(docs(spark, data), words, percent).collect())
    assert got == brute_groups(data, words, percent)


def test_near_duplicates_on_odd_rows(spark):
    got = Counter(tuple(x)[:4] for x in bb.groups(odd(spark), 3, 85).collect())
    assert got == brute_groups(odd_rows(), 3, 85)
    assert bb.groups(docs(spark, [])).collect() == []


def test_one_row_of_each_group_stays(spark):
    got = Counter((x.doc_id, x.text) for x in bb.deduplicated(odd(spark)).collect())
    plain = odd_rows()[0][1]
    want = Counter((i, t) for i, t, _ in odd_rows())
    for row in [(1, plain), (7, plain), (None, plain)]:
        del want[row]
    want[1, plain] = 1
    assert got == want
    assert bb.deduplicated(odd(spark)).columns == odd(spark).columns
    assert bb.deduplicated(docs(spark, [])).collect() == []


def test_estimate_corrects_for_collisions(spark):
    r, a, b = np.random.default_rng(1), *bb._coefficients(64)
    x = np.unique(r.integers(0, 1 << 63, 900, dtype=np.uint64))
    y = np.concatenate([x[:800], np.unique(r.integers(0, 1 << 63, 100, dtype=np.uint64))])
    mx, my = bb.minima(x, a, b), bb.minima(y, a, b)
    df = spark.createDataFrame([(bb.signature(mx), bb.signature(my))], "p array<bigint>, q array<bigint>")
    got = df.select(bb.differing("p", "q", 4).alias("d")).first().d
    low = np.uint64((1 << bb.BITS) - 1)
    assert got == int(((mx & low) != (my & low)).sum()) <= bb.most_differing(0.8, 64)
    assert bb.most_differing(0.85, 64) < 64 * (1 - 0.5 ** bb.BITS) - 4.5 * 2
    assert (1 - 0.85 ** bb.ROWS) ** bb.bands_for(0.85) <= bb.MISS


# -- search and vector groups

def vector_rows(seed=1, n=300, width=8):
    r, out = np.random.default_rng(seed), []
    for i in range(n):
        v = (r.normal(size=width) if i % 3 else np.ones(width) + r.normal(size=width) * (i % 2) * 0.05).astype(np.float32)
        out.append((i, [float(x) for x in v], i % 4 if i % 11 else None))
    return out + [(900, None, 1), (901, [1.0, None] + [0.0] * 6, 1), (902, [float("nan")] + [0.0] * 7, 1),
                  (903, [float("inf")] + [0.0] * 7, 1), (904, [0.0] * 8, 1), (None, [1.0] * 8, 1), (905, [], 1),
                  (906, out[1][1], 1), (907, out[1][1], 1), (907, out[1][1], 1), (1000, out[0][1], 2)]


def vectors(spark, data):
    return clashing(spark.createDataFrame(data, "vec_id bigint, embedding array<float>, kind int").withColumnRenamed("kind", "cls"))


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("tile,run", [(4096, 12), (16, 2)])
def test_search_against_brute_force(spark, monkeypatch, tile, run):
    monkeypatch.setattr(topk_search, "TILE", tile)
    monkeypatch.setattr(topk_search, "RUN", run)
    monkeypatch.setattr(topk_search, "FAN", 2)
    data = vector_rows()
    got = rows(topk_search.search(vectors(spark, data), F.col("vec_id") % 100 == 0))
    kept = [(i, np.floor(np.array(v, dtype=float) * 1024).astype(int)) for i, v, _ in data if i is not None and usable(v)]
    want = set()
    for q, x in kept:
        if q % 100 == 0:
            best = sorted((-(int(x @ y) if len(x) and len(y) else 0), i) for i, y in kept if i != q)[:10]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    # rows repeated under one id give that id twice
    assert Counter((q, k, s) for q, k, _, s in got) == Counter((q, k, s) for q, k, _, s in want)
    assert set(got) == want


def test_search_on_few_and_no_rows(spark):
    few = [(0, [1.0, 0.0], 1), (100, [0.5, 0.5], 1)]
    assert rows(topk_search.search(vectors(spark, few), F.col("vec_id") % 100 == 0)) == [(0, 1, 100, 1024 * 512), (100, 1, 0, 1024 * 512)]
    assert topk_search.search(vectors(spark, []), F.lit(True)).collect() == []
    assert topk_search.search(vectors(spark, few), F.lit(False)).collect() == []


def brute_vectors(data, cosine):
    taking = [k for k, (i, v, c) in enumerate(data) if i is not None and c is not None and usable(v) and any(v)]
    unit = {k: np.array(data[k][1], dtype=float) / np.linalg.norm(data[k][1]) for k in taking}
    pairs = [(a, b) for a in taking for b in taking if b < a and data[a][2] == data[b][2] and len(unit[a]) == len(unit[b]) and
             (unit[a] @ unit[b] >= cosine or data[a][1] == data[b][1])]
    root, links = union_find(range(len(data)), pairs), Counter(k for p in pairs for k in p)
    least = defaultdict(list)
    for k, (i, *_) in enumerate(data):
        least[root[k]].append(i)
    return Counter((i, links[k], min(least[root[k]]) if i is not None else None) for k, (i, *_) in enumerate(data))


@pytest.mark.parametrize("leaf", [512, 12])
def test_vector_groups_against_all_pairs(spark, monkeypatch, leaf):
    monkeypatch.setattr(forest, "LEAF", leaf)
    monkeypatch.setattr(forest, "TILE", 2 * leaf)
    data = vector_rows()
    got = forest.groups(vectors(spark, data), label="cls").collect()
    assert Counter((x.vec_id, x.n_links, x.component_id) for x in got) == brute_vectors(data, 0.98)
    assert all(x.kept == (x.vec_id is None or x.vec_id == x.component_id) for x in got)


def test_dense_groups_hand_on_no_lists_of_links(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF", 64)
    monkeypatch.setattr(forest, "TILE", 128)
    r = np.random.default_rng(8)
    centre, far = r.normal(size=(3, 16)), r.normal(size=(300, 16))
    data = [(i, (centre[i % 3] + r.normal(scale=0.12, size=16)).tolist(), 1) for i in range(900)]
    data += [(1000 + i, v.tolist(), 1) for i, v in enumerate(far)]
    got = forest.groups(vectors(spark, data), label="cls").collect()
    assert Counter((x.vec_id, x.n_links, x.component_id) for x in got) == brute_vectors(data, 0.98)
    links = sum(x.n_links for x in got) // 2
    classes = vectors(spark, data).select(F.col("vec_id").alias("node"), F.lit(1).alias("label"), F.lit(1).alias("n"),
                                          F.col("embedding").alias("vector"))
    out = forest.links(classes, 0.98)
    assert out.count() < links / 4 and out.agg(F.sum("others")).first()[0] == 2 * links


def test_cells_met_before_and_spanning_links(monkeypatch):
    monkeypatch.setattr(forest, "COLUMNS", 2)
    r = random.Random(9)
    held = [np.array(r.sample(range(12), 4)) for _ in range(20)]
    met = forest.met_before(held, 7)
    assert all(met[i, j] == any(c < 7 for c in set(held[i]) & set(held[j])) for i in range(20) for j in range(20) if i != j)
    linked = np.zeros((20, 20), dtype=bool)
    for a, b in [(0, 5), (5, 9), (0, 9), (3, 4), (12, 19)]:
        linked[a, b] = linked[b, a] = True
    tree = forest.spanning(linked)
    assert len(tree) == 4 and union_find(range(20), tree) == union_find(range(20), zip(*np.nonzero(linked)))


def test_vector_groups_on_no_rows(spark):
    assert forest.groups(vectors(spark, []), label="cls").collect() == []
    only = vectors(spark, [(1, None, 1), (2, [1.0], None)])
    assert rows(forest.groups(only, label="cls")) == [(1, 0, 1, True), (2, 0, 2, True)]


# -- mixing

def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    left, free, out = sum(sizes.values()), set(order), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**out, **share}
        for s in over:
            out[s] = 3.0 * sizes[s]
            free.discard(s)
            left -= out[s]


def test_targets_and_taken_words(spark):
    r = random.Random(5)
    data = [(i, sentence(r, r.randrange(0, 400)), r.choice(["a", "b", "b", "b", "b", "c", "é", None])) for i in range(400)]
    data += [(1000, sentence(r, 40_000), "huge"), (1001, sentence(r, 300), "tiny")]
    got = mixing.mix(docs(spark, data)).collect()
    sizes, source = Counter(), {i: s for i, _, s in data}
    for _, t, s in data:
        sizes[s] += len(t.split())
    want, taken = brute_targets(sizes), Counter()
    for x in got:
        s = source[x.doc_id]
        assert x.source_size == sizes[s] and x.target == pytest.approx(want[s]) and 0 <= x.taken <= 3 * x["size"]
        taken[s] += x.taken
    assert {x.doc_id: x["size"] for x in got} == {i: len(t.split()) for i, t, _ in data}
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * mixing.BLOCK + 0.01 * want[s], s
    assert rows(mixing.mix(docs(spark, data))) == rows(mixing.mix(docs(spark, data).repartition(7)))


def test_permutations_are_one_to_one(spark):
    df = spark.range(0, 1000).select(F.col("id") % 250, F.lit(250).cast("bigint").alias("n"), (F.col("id") / 250).cast("bigint").alias("t"))
    got = df.toDF("k", "n", "t").select("t", mixing.permuted(F.col("k"), F.col("n"), F.col("t"), F.lit("s")).alias("p")).collect()
    for t in range(4):
        assert sorted(x.p for x in got if x.t == t) == list(range(250))
    assert len({tuple(x.p for x in got if x.t == t) for t in range(3)}) == 3


def test_shard_counts_are_a_draw(spark):
    goals = spark.createDataFrame([("a", 500, 3000, 0), ("b", 900, 1000, 3000)], "source string, n_blocks bigint, n_slots bigint, first bigint")
    got = mixing.slots(goals, shard=1000).groupBy("source", "shard").count().collect()
    counts = {(x.source, x.shard): x["count"] for x in got}
    for s in range(4):
        a, b = counts["a", s], counts["b", s]
        assert abs(a - 0.75 * (a + b)) < 5 * (0.1875 * (a + b)) ** 0.5
    uses = mixing.slots(goals).where("source = 'a'").groupBy("index").count().collect()
    assert len(uses) == 500 and {x["count"] for x in uses} == {6}


def test_mixed_slots_hold_the_words_that_mix_counts(spark):
    r = random.Random(6)
    data = [(i, sentence(r, r.randrange(0, 300)), r.choice(["a", "b", "b", None])) for i in range(80)] + [(99, sentence(r, 5000), "a")]
    got = mixing.mixed(docs(spark, data), shard=20).collect()
    size, by_slot, taken = {i: len(t.split()) for i, t, _ in data}, defaultdict(list), Counter()
    for x in got:
        assert 0 <= x.first_word < x.end_word <= size[x.doc_id]
        taken[x.doc_id] += x.end_word - x.first_word
        by_slot[x.shard, x.slot, x.source, x["index"]].append((x.at, x.end_word - x.first_word))
    assert {x.doc_id: x.taken for x in mixing.mix(docs(spark, data)).collect()} == {i: taken[i] for i in size}
    assert sorted(k[1] for k in by_slot) == list(range(len(by_slot))) and len({k[0] for k in by_slot}) > 2
    for parts in by_slot.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert 0 < end <= mixing.BLOCK


def test_copies_keep_each_source_near_its_target(spark):
    r = random.Random(7)
    data = [(i, sentence(r, 300 + 40 * (i % 50)), "abc"[i % 3] if i % 10 else None) for i in range(300)]
    data += [(1000, data[4][1], "b"), (1000, data[4][1], "b"), (None, data[7][1], "b"), (None, data[7][1], "b")]
    taken, longest, source = Counter(), Counter(), {i: s for i, _, s in data}
    for x in mixing.mix(docs(spark, data)).collect():
        taken[source[x.doc_id]] += x.taken
        longest[source[x.doc_id]] = max(longest[source[x.doc_id]], x["size"])
    got = Counter()
    for x in mixing.copies(docs(spark, data)).collect():
        got[x.source] += len(x.text.split())
    for s in taken:
        assert abs(got[s] - taken[s]) <= 2 * longest[s], s


def test_mixing_odd_rows(spark):
    got = mixing.mix(odd(spark)).collect()
    assert Counter((x.doc_id, x["size"]) for x in got) == Counter((i, len((t or "").encode().split())) for i, t, _ in odd_rows())
    assert mixing.mix(docs(spark, [])).collect() == []
    assert {x.taken for x in mixing.mix(docs(spark, [(1, None), (2, "")])).collect()} == {0}
    copies = mixing.copies(odd(spark))
    assert copies.columns == odd(spark).columns and all(x.text and x.text.split() for x in copies.collect())


# -- registration and pipeline

def test_registered_queries():
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == [n for k in range(1, 11) for n in QUERIES if n.startswith(f"op{k}_")]
    assert len(QUERIES) == 10 and set(ORACLE) <= set(QUERIES)


def test_archive_query_equals_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    names = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    want = duck.execute(f"SELECT {names} FROM ({ORACLE['op4_warc_index']})").fetchall()
    assert rows(QUERIES["op4_warc_index"](spark, sf_dir)) == sorted(want, key=repr)


def test_pipeline_stages(spark, sf_dir, tmp_path):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "source_mix", "packing"]
    now, seen = documents, {}
    for name, step in corpus_pipeline.STAGES:
        step(spark, now, sf_dir).write.parquet(str(tmp_path / name))
        now = seen[name] = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert now.columns == documents.columns
    ids = {n: {x.doc_id for x in df.select("doc_id").distinct().collect()} for n, df in seen.items()}
    whole = [(x.doc_id, x.text) for x in seen["quality"].collect()]
    assert {i for (i, _, _, kept) in brute_groups(whole, 5, 80) if kept} == ids["near_duplicates"] == ids["personal_data"]
    assert not seen["personal_data"].where(F.col("text").rlike(r"[a-z]@mail[0-9]\.example\.com")).count()
    assert ids["packing"] == ids["source_mix"] <= ids["personal_data"]
    times = seen["source_mix"].groupBy("doc_id").count().collect()
    assert max(x["count"] for x in times) <= 3
    assert sum(x["length"] for x in seen["packing"].collect()) > 0
