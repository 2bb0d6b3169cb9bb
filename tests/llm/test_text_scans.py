"""Secret scan, personal data, decontamination and sharding against brute force."""

import random

import pytest
from brute import (added_spans, contamination, crc, digest, docs_frame, personal, saved, secrets)
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tidewatch.llm import decontaminate, pii, secret_scan, sharding
from tidewatch.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"

SECRETS = [
    None, "", " ", "plain words only", "password = 'abcdef' é token=abc", "token=token:abcdefgh secret=secret:zz",
    'API_KEY:"x.y=z/w+q" apikey=123456', "AKIA" + "A" * 16, "AKIA" + "B" * 15, "xAKIAAKIA" + "Z" * 20,
    "é" * 30 + "deadbeef" * 3, "0" * 23, "f" * 100 + " " + "e" * 24, "Password  :  hunter2hunter2\nsecret\"=\"aaaaaa",
    "token token=abcdef token = 'ghijkl' " * 50, "😀 passwd=longer-value 😀 " + "ab12" * 10,
    "secret=" + "x" * 5 + " key", "token=a" + " " * 2000 + "token=bcdefg",
]


def test_secrets_match_plain_patterns(spark, tmp_path):
    d = saved(spark, docs_frame(spark, SECRETS * 2), tmp_path)
    got = {r["doc_id"]: r for r in secret_scan.secret_rows(d).collect()}
    for i, t in enumerate(SECRETS * 2):
        want = secrets(t)
        r = got[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[1] == k for s in want) for k in (1, 2, 3)), t
        assert r["base_sha256"] == digest(want), t


def test_secrets_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op2_secret_scan"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["base_sha256"] == digest(secrets(texts[r["doc_id"]]))


def test_added_spans_match_brute_force(spark, tmp_path):
    rng = random.Random(3)
    texts = SECRETS + common_texts(rng, 40) + [f"{random_key(rng, 30)}, password={random_key(rng, 25)}{x}" for x in " .=/é"]
    model = secret_scan.fit_models(secret_scan.labelled_samples(docs_frame(spark, texts)))
    for r in secret_scan.scan(docs_frame(spark, texts), model).collect():
        assert [(s["s"], s["k"], s["e"], s["v"]) for s in r["spans"]] == added_spans(texts[r["doc_id"]] or "", model)


def test_markov_ratio_parts_random_from_words(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["the", "on", "er", "in", "ation", "ing", "sh"]) for _ in range(4))
    key = lambda n: "".join(rng.choice("ABCDEFGHJKMNPQRSTVWXYZabcdefghjkmnpqrstvwxyz23456789") for _ in range(n))
    samples = spark.createDataFrame([("word", word(), i % 2 == 0) for i in range(400)]
                                    + [("random", key(32), False) for _ in range(200)],
                                    "label string, value string, held boolean")
    model = secret_scan.fit_models(samples)
    unknown, plain = key(30) + "7x", "theoninger_ationshinger_12"
    d = spark.createDataFrame([(1, f"see {unknown} and {plain} é"), (2, None), (3, "x" * 40)], "doc_id int, text string")
    got = {r["doc_id"]: [(s["s"], s["e"], s["k"]) for s in r["spans"]] for r in secret_scan.scan(d, model).collect()}
    assert got == {1: [(4, 36, 4)], 2: [], 3: []}


def test_rare_secrets_fit_the_model_in_a_large_table(spark, tmp_path):
    rng = random.Random(7)
    key = lambda n: "".join(rng.choice("ABCDEFGHJKMNPQRSTVWXYZabcdefghjkmnpqrstvwxyz23456789") for _ in range(n))
    texts = [f"another {w} sentence mentions nothing particular {i}" for i in range(6000) for w in ("ordinary", "common")]
    texts += [f"token={key(36)} here" for _ in range(30)] + [f"see {key(30)}x7 there"]
    d = saved(spark, docs_frame(spark, texts), tmp_path)
    got = {r["doc_id"]: r["spans"] for r in secret_scan.secret_rows(d).where("n_markov > 0").collect()}
    assert got == {len(texts) - 1: "markov:4:36"}


KEYS = "ABCDEFGHJKMNPQRSTVWXYZabcdefghjkmnpqrstvwxyz23456789"


def random_key(rng, n):
    return "".join(rng.choice(KEYS) for _ in range(n - 1)) + "7"


def common_texts(rng, n):
    stems = ["order", "number", "house", "particular", "mention", "ordinary", "sentence", "under", "another", "thing"]
    return [" ".join(rng.choice(stems) + rng.choice(["", "s", "_id", "er", "ing", "ally"]) for _ in range(30)) for _ in range(n)]


def test_without_labelled_secrets_random_strings_are_even(spark, tmp_path):
    rng = random.Random(11)
    texts = common_texts(rng, 300) + [f"see {random_key(rng, 36)} there" for _ in range(10)] + ["a_common_identifier_of_order_12"]
    got = secret_scan.secret_rows(saved(spark, docs_frame(spark, texts), tmp_path)).where("n_markov > 0").collect()
    assert {r["doc_id"]: r["spans"] for r in got} == {i: "markov:4:40" for i in range(300, 310)}
    none = secret_scan.fit_models(spark.createDataFrame([], "label string, value string, held boolean"))
    assert none["threshold"] == 0 and set(none["table"]) == {0.0}


def test_unlabelled_secrets_do_not_raise_the_threshold(spark, tmp_path):
    rng = random.Random(13)
    texts = common_texts(rng, 3000)
    texts += [f"token={random_key(rng, 36)} here" for _ in range(60)]
    texts += [f"see {random_key(rng, 36)} there" for _ in range(60)]
    d = saved(spark, docs_frame(spark, texts), tmp_path)
    got = {r["doc_id"] for r in secret_scan.secret_rows(d).where("n_markov > 0").collect()}
    assert got <= set(range(3060, 3120)) and len(got) >= 58


def test_long_runs_and_many_spans_in_one_text(spark):
    rng = random.Random(17)
    model = secret_scan.fit_models(spark.createDataFrame(
        [("word", w, i % 2 == 0) for i, t in enumerate(common_texts(rng, 50)) for w in t.split()]
        + [("random", random_key(rng, 40), False) for _ in range(200)], "label string, value string, held boolean"))
    letters = "".join(rng.choice(KEYS[:44]) for _ in range(700))
    texts = [f"see {letters}5x there", f"{'9' * 600}{letters} x", "a" * 3000 + "1",
             " ".join("%032x" % rng.getrandbits(128) for _ in range(30000)),
             " ".join(random_key(rng, 24) + (" token=abcdefgh" if i % 3 == 0 else "") for i in range(2000))]
    rows = secret_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).collect()
    got = {r["doc_id"]: [(s["s"], s["k"], s["e"], s["v"]) for s in r["spans"]] for r in rows}
    for i, t in enumerate(texts):
        assert got[i] == added_spans(t, model), i
    assert got[0] == [(4, 4, 706, letters + "5x")] and len(got[3]) >= 29900


PERSONAL = [
    None, "", "no data", "a@b.c x@y@z.com", "mail: first.last+tag%x@mail.example.co.uk, é a@b", "@b.c @@ a@b.c@d.e",
    "1.2.3.4 256.1.1.1 1.2.3.4.5 01.02.003.255 1.2.3.4.5.6.7.8", "9" * 5000 + ".1.2.3", "4111 1111 1111 1111 x",
    "4111-1111-1111-1111 5500005555555559 4111111111111112", "4111  1111 1111 1111", "+1 (555) 123-4567 and +12 34",
    "+1 234 567 8901 234 56 +44.20.7946.0958-", "++1 5551234567 +1" + " " * 500 + "2", "😀 a.b@c.de 10.0.0.1 +15551234567",
    "0" * 16 + " " + "4" * 20, "call 4111 1111 1111 1111 4111 1111 1111 1111",
]


def test_personal_data_matches_plain_patterns(spark, tmp_path):
    d = saved(spark, docs_frame(spark, PERSONAL * 2), tmp_path)
    got = {r["doc_id"]: r for r in pii.personal_rows(d).collect()}
    for i, t in enumerate(PERSONAL * 2):
        want = personal(t) if not t or len(t) < 4000 else []
        r = got[i]
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(
            sum(s[1] == k for s in want) for k in (1, 2, 3, 4)), t
        assert r["base_sha256"] == digest(want), t


def test_personal_data_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op8_personal_data"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        want = personal(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(want)
        assert [s for s in r["spans"].split(",") if s and not s.startswith(pii.FOUND)] == [
            f"{k}:{s}:{e}" for s, _, e, k in sorted(want)]


def test_patterns_discover_unseen_identifiers(spark, tmp_path):
    seeds = [f"word{i % 7} please call me at +1 (555) 123-{4000 + i} today" for i in range(20)]
    new = ["kindly please call me at 555.123.9876 today", "order number 555.123.9877 was sent"]
    d = saved(spark, docs_frame(spark, seeds + new), tmp_path)
    got = {r["doc_id"]: r["spans"] for r in pii.personal_rows(d).collect()}
    at = new[0].index("555")
    assert got[20] == f"ctx_phone:{at}:{at + 12}"
    assert got[21] == ""


def test_patterns_discover_every_written_form(spark, tmp_path):
    seeds = [f"word{i % 7} please call me at +1 (555) 123-{4000 + i} today" for i in range(30)]
    seeds += [f"x{i}y | +1 (555) 124-{4000 + i} | is my phone" for i in range(30)]
    seeds += [f"reach user{i}@example.com by mail" for i in range(30)]
    forms = [("please call me at ", "(017) 555-7713", " today"), ("please call me at ", "555 123 4567", " today"),
             ("please call me at: ", "4111 1111 1111 1112", " today"), ("call me at : ", "0171234567", " today"),
             ("call me at | ", "0171234568", " | now"), ("", "555.123.9878", " is my phone"),
             ("reach ", "someone@localhost", " by mail"), ("please call me at ", "x4711", " today")]
    d = saved(spark, docs_frame(spark, seeds + [a + b + c for a, b, c in forms] + ["order (018) 555-7713 sent"]), tmp_path)
    got = {r["doc_id"]: r["spans"] for r in pii.personal_rows(d).collect()}
    for i, (a, b, _) in enumerate(forms):
        kind = "email" if "@" in b else "phone"
        assert got[len(seeds) + i] == f"ctx_{kind}:{len(a)}:{len(a + b)}", (a, b)
    assert got[len(seeds) + len(forms)] == ""


def test_rounds_go_on_until_nothing_is_new(spark):
    edges = [("p0", f"s{i}", 1) for i in range(60)]
    for step in range(6):          # the instances found by p_n are the seeds of p_n+1
        edges += [(f"p{step + j}", f"u{step}_{i}", 0) for i in range(12) for j in (0, 1)]
    found = pii.score_graph(spark.createDataFrame(edges, "pattern string, inst string, k int"),
                            min_pattern=0.01, min_instance=0.01)
    assert found.count() == 72


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (3, None),
         (4, "..."), (5, "Alpha, beta gamma delta epsilon zeta eta theta iota kappa"), (None, "nameless thing here"),
         (1, "short item"), (6, "été à la plage " * 4)]
LEAKS = [None, "", "x " * 30, "one ALPHA beta gamma delta-epsilon zeta eta theta iota kappa lambda mu nu",
         "a short item and SHORT  item", "nameless thing here", "alpha beta gamma delta epsilon zeta eta theta iota",
         "ÉTÉ à la plage été à la plage été à la plage", "été à la plage été à la plage été à la plage",
         "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 200]


@pytest.mark.parametrize("block", [1 << 20, 1])
def test_contamination_small(spark, tmp_path, block):
    d = saved(spark, docs_frame(spark, LEAKS), tmp_path)
    b = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {r["doc_id"]: r for r in decontaminate.scan_hits(d, b, block).collect()}
    for i, (n, hit, who) in enumerate(contamination(LEAKS, ITEMS)):
        r = got[i]
        assert r["n_words"] == n and sum(y - x for x, y in r["hits"]) == hit, LEAKS[i]
        assert r["items"] == sorted(x for x in who if x != "None")


def test_contamination_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = contamination([r["text"] for r in rows], items)
    got = {r["doc_id"]: r for r in QUERIES["op3_decontamination"](spark, SF).collect()}
    import hashlib
    assert sum(w[1] > 0 for w in want) > 5
    for r, (n, hit, who) in zip(rows, want):
        g = got[r["doc_id"]]
        assert (g["n_words"], g["n_hit"], g["n_items"], g["contaminated"]) == (n, hit, len(who), hit > 0)
        assert g["items_sha256"] == hashlib.sha256(",".join(who).encode()).hexdigest()


def test_decontaminate_documents_and_spans(spark, tmp_path):
    d = saved(spark, docs_frame(spark, LEAKS), tmp_path)
    b = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = decontaminate.decontaminate(d, b)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 6]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(d, b, "spans").collect()}
    assert cut[3] == "one  nu" and cut[4] == "a  and " and cut[2] == LEAKS[2] and cut[0] is None
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.decontaminate(d, empty).count() == len(LEAKS)


def test_permutation_is_a_bijection():
    import numpy as np
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        assert sorted(sharding.permute(np.arange(n), n).tolist()) == list(range(n))
    assert sharding.permute(np.arange(100), 100, seed=1).tolist() != sharding.permute(np.arange(100), 100, seed=2).tolist()


def check_shards(rows, texts):
    by = {}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, crc(raw))
        by.setdefault(r["shard"], []).append(r["slot"])
        assert sharding.locate(r["number"], len(rows)) == (r["shard"], r["slot"])
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))
    sizes = [len(by.get(s, [])) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op4_sharding"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    check_shards(rows, texts)


def test_shards_of_awkward_rows(spark, tmp_path):
    ids = [None, None, 3, 3, 3, 5, 6, 7, 8, 9]
    texts = ["a", None, "é", "é", "", "x", "y", "z", "w", "v"]
    d = saved(spark, docs_frame(spark, texts, ids=ids), tmp_path)
    rows = sharding.shard_rows(d).collect()
    assert sorted((r["shard"], r["slot"]) for r in rows) == sorted((p % 8, p // 8) for p in range(10))
    assert sharding.shard_rows(d.limit(0)).count() == 0


@pytest.mark.parametrize("run", [secret_scan.secret_rows, pii.personal_rows])
def test_empty_table(spark, tmp_path, run):
    assert run(saved(spark, docs_frame(spark, ["x"]).where("false"), tmp_path)).count() == 0
    empty = docs_frame(spark, ["x"]).where(F.lit(False))
    assert decontaminate.contamination_rows(empty, spark.createDataFrame(ITEMS, "item_id bigint, text string")).count() == 0
