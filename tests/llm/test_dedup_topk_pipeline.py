"""Near-dedup, line dedup, components, top-k and the pipeline against brute force."""

import random

import pytest
from brute import contamination, docs_frame, line_components, near, saved, shingle_set, topk
from conftest import SF_SMALL
from tidewatch.llm import line_dedup, near_dedup
from tidewatch.llm.catalog import QUERIES
from tidewatch.llm.components import connected_components
from tidewatch.llm.topk import top_k

SF = "/root/testdata/sf0.01"


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (20, 21), (5, 5), (30, 9)] + [(100 + i, 101 + i) for i in range(40)]
    got = dict(connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert {k: got[k] for k in (1, 2, 3, 9, 30, 20, 21)} == {1: 1, 2: 1, 3: 1, 9: 1, 30: 1, 20: 20, 21: 20}
    assert all(got[i] == 100 for i in range(100, 141)) and 5 not in got
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def check_near(rows, ids, texts):
    want = near(ids, texts)
    assert len(rows) == len(ids)
    for r in rows:
        n, c = want[r["doc_id"]]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (n, c, r["doc_id"] == c), r


def test_near_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check_near(QUERIES["op6_near_dedup"](spark, SF).collect(), [r[0] for r in rows], [r[1] for r in rows])


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [256, 4])
def test_near_groups_of_near_copies(spark, tmp_path, block):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \t\n", "one two", "ONE  two", "one two three four five", "a b c d e"] * 2
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(40, 160))]
        texts += variants(rng, base, 12, rng.randint(0, 4))
    shared = [rng.choice(words) for _ in range(120)]      # a passage that many texts share, at many ratios
    for i in range(40):
        texts.append(" ".join(shared + [rng.choice(words) for _ in range(rng.randint(5, 120))]))
    rng.shuffle(texts)
    d = saved(spark, docs_frame(spark, texts), tmp_path)
    rows = near_dedup.near_duplicates(d, block=block).collect()
    want = near(list(range(len(texts))), texts)
    for r in rows:
        n, c = want[r["doc_id"]]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (n, c, r["doc_id"] == c)
    kept = near_dedup.drop_near_duplicates(d)
    assert kept.columns == d.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}


def test_near_repeated_ids_keep_one_row(spark, tmp_path):
    d = saved(spark, docs_frame(spark, ["a b c d e f g"] * 3 + ["z"] * 2, ids=[4, 4, None, None, None]), tmp_path)
    rows = near_dedup.near_duplicates(d).collect()
    assert sum(r["kept"] for r in rows) == 2
    assert sorted(str(r["component_id"]) for r in rows) == ["4", "4", "4", "None", "None"]
    assert near_dedup.near_rows(d.where("false")).count() == 0


def test_odd_sketch_estimates_high_similarity():
    import numpy as np
    rng = np.random.default_rng(0)
    for s in (0.75, 0.9):
        one = rng.integers(0, 1 << 32, (400, 96), dtype=np.uint32)
        other = np.where(rng.random((400, 96)) < s, one, rng.integers(0, 1 << 32, (400, 96), dtype=np.uint32))
        d = np.bitwise_count(near_dedup.odd_sketches(one) ^ near_dedup.odd_sketches(other)).sum(axis=1)
        est = 1 + 512 / (4 * 96) * np.log(1 - 2 * d / 512)
        assert abs(est.mean() - s) < 0.02
        assert (d <= near_dedup.most_differing_bits(96, 75)).all()


def line_keys(text):
    return [(i, x.strip(" ").lower()) for i, x in enumerate((text or "").split("\n")) if x.strip(" ")]


def check_lines(rows, docs):
    comp = line_components([k for _, t in docs for _, k in line_keys(t)])
    first, want = {}, {}
    for d, t in sorted(docs):
        for i, k in line_keys(t):
            c = comp[k]
            want[d, i] = (c, first.setdefault(c, (d, i)) == (d, i))
    got = {(r["doc_id"], r["line_no"]): (r["component"], r["kept"]) for r in rows}
    assert set(got) == set(want)
    names = {}
    for key, (c, kept) in want.items():
        assert names.setdefault(c, got[key][0]) == got[key][0], key
        assert got[key][1] == kept, key
    assert len(set(names.values())) == len(names)


def test_lines_whole_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    check_lines(QUERIES["op5_line_dedup"](spark, SF_SMALL).collect(), [tuple(r) for r in rows])


def test_lines_small(spark, tmp_path):
    rng = random.Random(8)
    long = "the quick brown fox jumps over the lazy dog while the band plays on and on in the evening rain"
    texts = [None, "", "\n\n", "abc\nABC \nabd", long + "\nother line of text here", f"new first line\n{long}!",
             long.replace("quick", "quack"), "x\n\nx\ny", "  spaced  \nspaced", "é" * 7 + "\n" + "é" * 8,
             "\n".join("".join(rng.choice("abcdef ") for _ in range(60)) + "z" for _ in range(30))]
    d = saved(spark, docs_frame(spark, texts), tmp_path)
    check_lines(line_dedup.line_rows(d).collect(), list(enumerate(texts)))
    out = {r["doc_id"]: r["text"] for r in line_dedup.drop_duplicate_lines(d).collect()}
    assert 6 not in out and out[0] is None and out[1] == "" and out[2] == "\n\n"
    assert out[3] == "abc\nabd" and out[5] == "new first line" and out[7] == "x\n\ny" and out[8] == "  spaced  "
    assert line_dedup.drop_duplicate_lines(d).columns == d.columns
    assert line_dedup.line_rows(d.where("false")).count() == 0


def test_line_dedup_saves_no_text_of_its_lines(spark, tmp_path):
    rows = [(1, "one long line of words\nshort"), (2, "SHORT \none long line of wordz"), (3, None), (4, " \n")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/docs")
    marked = line_dedup.duplicate_lines(spark.read.parquet(f"{tmp_path}/docs"), percent=70)
    tables = {f.rsplit("/", 1)[0] for f in marked.inputFiles()}
    types = [t for path in tables for _, t in spark.read.parquet(path).dtypes]
    assert tables and not {"string", "array<bigint>"} & set(types)
    assert sorted((r["doc_id"], r["line_no"], r["kept"]) for r in marked.collect()) == [
        (1, 0, True), (1, 1, True), (2, 0, False), (2, 1, False)]


@pytest.mark.parametrize("held", [0, 40, 10_000])
def test_only_keys_of_two_lines_are_left(monkeypatch, held):
    import pyarrow as pa
    monkeypatch.setattr(line_dedup, "PARTS", 4)
    monkeypatch.setattr(line_dedup, "PACKED", 100)
    monkeypatch.setattr(line_dedup, "HELD", held)
    rng = random.Random(held)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(3, 60))) for _ in range(40)]
    lines = base + [t + "#" for t in base[:10]] + ["x"] + base[5:15]
    h = [hash(t) for t in lines]
    batches = [pa.RecordBatch.from_pydict({"h": h[i:i + 7], "line": lines[i:i + 7]}) for i in range(0, len(lines), 7)]
    keys = line_dedup.sign(pa.array(lines), *line_dedup.odd_multipliers(24, 11), 3, 8)
    of: dict[int, set] = {}
    for row, n in zip(keys.tolist(), h):
        for key in row:
            of.setdefault(key, set()).add(n)
    packed = sorted((r for _ in range(2) for b in line_dedup._signatures(iter(batches), 8, 3, 8) for r in b.to_pylist()),
                    key=lambda r: r["part"])
    packed = [pa.RecordBatch.from_pylist(packed[i:i + 3]) for i in range(0, len(packed), 3)]
    got = [(r["key"], r["h"]) for b in line_dedup._shared(iter(packed)) for r in b.to_pylist()]
    want = {(key, n) for key, some in of.items() if len(some) > 1 for n in some}
    assert want <= set(got) <= {(key, n) for key, some in of.items() for n in some} and want
    if held == 10_000:
        assert sorted(got) == sorted(want)
    else:
        assert len(got) > len(want)


def test_signatures_read_arrow_strings():
    import numpy as np
    import pyarrow as pa
    from tidewatch.llm.common import mix64, odd_multipliers, segment_minhash
    rng = random.Random(4)
    lines = ["é", "x" * 8, "日本語" * 5, "y" * 3000] + [
        "".join(rng.choice("ab é日😀") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    mult, mask = odd_multipliers(24, 11)
    flat, count = [], []
    for t in lines:
        acc = np.zeros(max(1, len(t) - 7), np.uint64)
        for k in range(8 if len(t) >= 8 else 0):
            acc *= np.uint64(0x9E3779B97F4A7C15)
            acc += np.array([ord(c) for c in t[k:k + len(acc)]], np.uint64)
        if len(t) < 8:
            import xxhash
            acc[0] = np.uint64(xxhash.xxh64_intdigest(t.encode()))
        flat.append(mix64(acc))
        count.append(len(acc))
    want = np.concatenate(flat)
    got, n = line_dedup.shingle_hashes(pa.array(["left out"] + lines)[1:], 8)
    assert got.tolist() == want.tolist() and n.tolist() == count
    sig = segment_minhash((want >> np.uint64(32)).astype(np.uint32), np.cumsum(count) - count, mult, mask)
    assert (line_dedup.minhashes(pa.array(lines, pa.large_string()), mult, mask, 8) == sig).all()


@pytest.mark.parametrize("size", [8, 5])
def test_pairs_of_lines_match_sets(size):
    import numpy as np
    rng = random.Random(size)
    lines = ["x", "é" * 30, "ab" * 400]
    for _ in range(150):
        base = "".join(rng.choice("abcd ") for _ in range(rng.randint(20, 200)))
        at = rng.randrange(len(base))
        lines += [base, base[:at] + "#" * rng.randint(0, 6) + base[at:]]
    sets = line_dedup.LineSets(lines, size)
    a = np.array([i for i in range(len(lines)) for _ in range(4)])
    b = np.array([j for i in range(len(lines)) for j in (i, i ^ 1, (i + 2) % len(lines), rng.randrange(len(lines)))])
    b = np.minimum(b, len(lines) - 1)
    want = []
    for i, j in zip(a, b):
        one, other = sets.shingles(i), sets.shingles(j)
        want.append(100 * len(one & other) >= 80 * len(one | other))
    assert sets.same(a, b, 80).tolist() == want and 0 < sum(want) < len(want)
    assert list(sets.counts) == [len(sets.shingles(i)) for i in range(len(lines))]


def test_spanning_links_meet_every_pair():
    import numpy as np
    import pandas as pd
    from tidewatch.llm.components import spanning_links
    rng = random.Random(1)
    keys = {n: np.array([n % 7 + 100, n % 5 + 200], np.int64) for n in range(60)}
    rows = []
    for k in sorted({int(k) for v in keys.values() for k in v}):
        nodes = [n for n in keys if k in keys[n]]
        blk = {n: rng.randrange(2) for n in nodes}
        for i, j in ((0, 0), (0, 1), (1, 1)):
            rows += [(k, i, j, blk[n], n, n // 3, keys[n]) for n in nodes if blk[n] in (i, j)]
    rng.shuffle(rows)
    frame = pd.DataFrame(rows, columns=["key", "i", "j", "blk", "node", "component", "keys"])
    node, met = frame["node"].to_numpy(), set()

    def near(a, b):
        pairs = [tuple(sorted(p)) for p in zip(node[a].tolist(), node[b].tolist())]
        assert met.isdisjoint(pairs) and len(set(pairs)) == len(pairs)
        met.update(pairs)
        return np.ones(len(a), bool)

    links = spanning_links(frame, lambda a, b: np.ones(len(a), bool), near)
    assert met == {(a, b) for a in keys for b in keys
                   if a < b and a // 3 != b // 3 and (keys[a] == keys[b]).any()}
    assert len(links) == 19     # 20 components of three nodes become one


def test_topk_whole_table(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op7_topk_search"](spark, SF_SMALL).collect())
    assert got == topk(rows)


@pytest.mark.parametrize("shard_rows", [8192, 40])
def test_topk_awkward_rows(spark, tmp_path, shard_rows):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(400 + i, [1.0, 0.0, 0.5, 0.0, 0.0, 0.25]) for i in range(30)]          # ties
    rows += [(100, rows[100][1]), (700, None), (800, []), (900, [1.0, None] * 3), (1000, [float("nan")] * 6),
             (1100, [float("inf")] * 6), (None, [1.0] * 6), (1200, [0.0] * 6), (1300, [3e6] * 6), (1400, [1.0, 2.0]),
             (1401, [0.5, 0.5])]
    d = saved(spark, spark.createDataFrame([(v, x, 1, "s") for v, x in rows],
                                           "vec_id bigint, embedding array<double>, row int, v string"), tmp_path)
    assert sorted(tuple(r) for r in top_k(d, shard_rows=shard_rows).collect()) == topk(rows)
    assert top_k(d.where("false")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    """Each stage on what its predecessor kept, judged by brute force on its own input."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = saved(spark, stage(spark, docs, SF), tmp_path, name)
        if name != "packing":
            assert docs.columns == names
            kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert set(kept[name]) <= set(before)
        if name == "language_id":
            assert len(kept[name]) >= 0.99 * len(before) and all(kept[name][d] == before[d] for d in kept[name])
        if name == "line_dedup":
            comp = line_components([k for t in kept[name].values() for _, k in line_keys(t)])
            lines = [comp[k] for t in kept[name].values() for _, k in line_keys(t)]
            assert len(lines) == len(set(lines))
        if name == "near_dedup":
            want = near(list(before), list(before.values()))
            assert set(kept[name]) == {d for d, (_, c) in want.items() if c == d}
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            hit = contamination(list(before.values()), items)
            assert set(kept[name]) == {d for d, (_, h, _) in zip(before, hit) if not h}
        if name == "packing":
            assert {r["doc_id"] for r in docs.collect()} == set(before)


def test_pipeline_handles_awkward_documents(spark, tmp_path):
    import corpus_pipeline
    texts = [None, "", "the and of ing with that this", "the and of ing with that this", "123"]
    docs = saved(spark, docs_frame(spark, texts), tmp_path)
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(spark, stage(spark, docs, SF), tmp_path, name)
    assert docs.select("doc_id").distinct().count() == 1
    assert shingle_set("") == frozenset()


def test_queries_are_registered():
    import __spark_entry__ as e
    names = set(e.queries())
    assert set(QUERIES) <= names and "pipeline" in names
