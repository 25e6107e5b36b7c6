"""Every operator over hard small tables and empty ones, against SQL or a brute-force version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests.compare import differences
from tokenizers import Tokenizer

import corpus_pipeline
from tablewright.llm import (
    components,
    decontamination,
    importance,
    jaccard_join,
    packing,
    quality_rules,
    substrings,
    toxicity,
    transcripts,
    url_filter,
    warc,
)
from tablewright.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
SCHEMAS = {
    # columns beyond the usual ones have names that operators use themselves
    "documents": "doc_id long, text string, lang string, source string, n_chars long, key long, host string, row int,"
    " cls long, hits int, starts int, left int, kept boolean, id long, words int",
    "pages": "page_id long, url string, html string, host string, tokens int, payload string, n int",
    "benchmark": "item_id long, text string, gram string, size int",
    "labels": "doc_id long, quality int, toxic int, id int, bad int",
    "conversations": "conv_id long, turn long, role string, text string, line int, block int, seen int",
}


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgäé") for _ in range(rng.randint(1, 7))) for _ in range(n))


def hard_tables():
    rng = random.Random(3)
    base, other, shared = prose(rng, 220), prose(rng, 180), prose(rng, 90)
    words = base.split(" ")
    near = [" ".join(w if rng.random() > 0.01 * k else "zz" for w in words) for k in range(8)]
    item = prose(rng, 30)
    footer = "All rights reserved by the  host of this page"
    texts = [None, "", " \n\t ", "one", "Two words", base, base, base.upper(), *near, base + " " + shared]
    texts += [other + " " + shared, prose(rng, 60) + shared + prose(rng, 60), "a" * 900, "ab" * 600, "x " * 500]
    texts += ["a" * 1200, prose(rng, 30) + item + prose(rng, 5), item, item.upper(), "No " + " ".join(item.split()[4:14])]
    texts += [" ".join(item.split()[4:13]), "tiny item", prose(rng, 60) + "\ntiny item\n<|endoftext|> 日本語 don't\r\n\r\n"]
    texts += [f"{footer}\n{prose(rng, 55)}\n{footer.upper()} " for _ in range(70)]
    texts += [f"{footer}\n{prose(rng, 2)}" for _ in range(3)] + ["#*$%&|<> " * 60, prose(rng, 3000), "idiot scum " + prose(rng, 50)]
    docs = [(i, t, "en", None if i % 11 == 0 else f"s{i % 2}", i) for i, t in enumerate(texts)]
    docs += [docs[5], docs[5], docs[20], (None, base, None, "s0", None), (None, None, None, None, None), (7, other, "en", "s1", 1)]
    pages = [(i, u, t, "x", 1, "p", 2) for i, (u, t) in enumerate(
        [("https://a.example.org/es/1", "<p>"), ("http://EXAMPLE.org/en/19?x=1#f", "<p>"), ("http://b.com/de/x", ""), (None, None),
         ("no scheme", "\r\n\r\n"), ("http://org", "\r\n\r\n\r\n"), ("x://y.org?/q", "é" * 70), ("http://notorg/", "é" * 70),
         ("http://u.com/fr/" + "a/" * 500, "WARC/1.1\r\n\r\nx"), ("http://u.com/fr/", "x" * 300000)])]
    pages += [pages[1], pages[1], (None, "http://c.net/", "<p>", "x", 1, "p", 2), (99, "http://c.net/", None, "x", 1, "p", 2)]
    bench = [(1, item), (2, item), (10, "Tiny Item"), (None, item), (3, None), (4, ""), (1, item), (5, "absent words here")]
    labels = [(i, i % 3 > 0, i % 5 == 0) for i in range(40)] + [(None, 1, 1), (1, None, None), (2, 1, 0), (2, 0, 1), (999, 1, 1)]
    talk = [(c, t, ("system", "user", "assistant")[0 if t == 0 and c % 4 == 0 else 1 + t % 2], f"{prose(rng, 5)}\n{prose(rng, 3)}")
            for c in range(12) for t in range(600 if c == 3 else 6)]
    talk += [(1, 2, None, None), (None, 0, "user", ""), (None, None, None, None), (5, 1, "other", "User: x"), (5, 1, "user", "x")]
    return {"documents": docs, "pages": pages, "benchmark": bench, "labels": labels, "conversations": talk}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = {}
    for kind in ("hard", "empty"):
        folder = tmp_path_factory.mktemp(kind)
        for name, rows in hard_tables().items():
            types = [x.split()[1] for x in SCHEMAS[name].split(", ")]
            rows = [(*(int(v) if isinstance(v, bool) else v for v in r), *([None] * (len(types) - len(r)))) for r in rows]
            df = spark.createDataFrame(rows if kind == "hard" else [], SCHEMAS[name])
            df.repartition(3).write.parquet(f"{folder}/{name}.parquet")
        out[kind] = str(folder)
    return out


@pytest.fixture(scope="module")
def hard(folders):
    return folders["hard"]


@pytest.fixture(scope="module")
def docs(hard):
    return duckdb.sql(f"select doc_id, text from '{hard}/documents.parquet/*.parquet'").fetchall()


def connect(folder):
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(SQL))
def test_equals_sql_on_hard_tables(spark, hard, key):
    assert differences(QUERIES[key](spark, hard), connect(hard), SQL[key]) == []


@pytest.mark.parametrize("key", sorted(SQL))
def test_equals_sql_on_given_tables(spark, key):
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    assert differences(QUERIES[key](spark, SMALL), con, SQL[key]) == []


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_empty_tables(spark, folders, key):
    assert QUERIES[key](spark, folders["empty"]).count() == 0


def test_pipeline_on_empty_tables(spark, folders):
    assert corpus_pipeline.run(spark, folders["empty"]).count() == 0


def test_pipeline_stages_on_hard_tables(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, hard)
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), docs.schema)
    left = {r["doc_id"] for r in docs.collect()}
    assert 5 in left and len({5, 6, 8} & left) == 1  # one of the copies, with its own text
    assert stage_texts(spark, hard, docs)


def stage_texts(spark, hard, docs):
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, hard)
    return packed.count() >= docs.count()


# op1


def test_archives_round_trip(spark, hard):
    pages = spark.read.parquet(f"{hard}/pages.parquet")
    folder = warc.scratch_folder(spark, "test")
    warc.write_archives(warc.as_records(pages), folder)
    back = warc.read_archives(spark, folder, payloads=True).collect()
    want = Counter((r["page_id"], (r["html"] or "").encode()) for r in pages.collect())
    assert Counter((r["page_id"], bytes(r["payload"])) for r in back) == want
    plain = warc.scratch_folder(spark, "test")
    spark.createDataFrame([("WARC/1.1",)], "value string").write.text(plain)
    with pytest.raises(Exception, match="no gzip file"):
        warc.read_archives(spark, plain).collect()
    again = warc.resolve(warc.read_archives(spark, folder, payloads=True), min_bytes=5).collect()
    assert {r["record_type"] for r in again if r["payload_bytes"] < 5} == {"response"}


def test_revisits_have_fresh_headers(spark):
    pages = spark.createDataFrame([(1, "http://a/1", "same"), (2, "http://a/2\r\nx", "same"), (3, None, "other")], "page_id long, url string, html string")
    folder = warc.scratch_folder(spark, "test")
    warc.write_archives(warc.resolve(warc.as_records(pages)), folder, "2024-05-06T07:08:09Z")
    text = "".join(r["value"] for r in spark.read.option("lineSep", "\0").text(folder).collect())
    head = dict(x.split(": ", 1) for x in text.split("WARC-Type: revisit")[1].split("\r\n\r\n")[0].strip().split("\r\n"))
    assert head["WARC-Refers-To"] == "<urn:record:2>" and head["WARC-Refers-To-Target-URI"] == "http://a/2x"
    assert head["WARC-Date"] == head["WARC-Refers-To-Date"] == "2024-05-06T07:08:09Z" and head["WARC-Target-URI"] == "http://a/1"
    found = {r["page_id"]: (r["record_type"], r["refers_to"], r["refers_to_uri"]) for r in warc.read_archives(spark, folder).collect()}
    assert found == {1: ("revisit", 2, "http://a/2x"), 2: ("response", None, None), 3: ("response", None, None)}


# op2


def test_frequent_lines_go(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    kept = quality_rules.clean(docs).filter("source = 's1'").collect()
    assert kept and not any("rights reserved" in r["text"].lower() for r in kept)
    assert all(r["n_chars"] == len(r["text"]) for r in kept if "\n" in r["text"])


def test_pipeline_cuts_boilerplate_of_large_hosts(spark):
    """One line in 30 texts of a host of 400, another in 20: only the first is over the count."""
    rng = random.Random(8)
    often, seldom = "All rights reserved by this host", "Some rights reserved by this host"
    rows = [(i, (often if i < 30 else seldom if i < 50 else "own") + f"\n{prose(rng, 60)}", "h") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = dict(corpus_pipeline.STAGES)["quality"](spark, docs, "").collect()
    found = Counter(r["text"].split("\n")[0] for r in left if "\n" in r["text"])
    assert len(left) == 400 and found[often] == 0 and found[seldom] == 20


# op3


def test_sample_has_its_size_and_prefers_the_target(spark, hard):
    rows = QUERIES["op3_importance_resampling"](spark, "/root/testdata/sf0.01").toPandas()
    labels = duckdb.sql("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").fetchall()
    share = sum(q == 1 for _, q in labels) / len(labels)
    assert rows["kept"].sum() == round(share * len(rows))
    weight = dict(zip(rows["doc_id"], rows["weight"]))
    good, bad = ([weight[d] for d, q in labels if q == k] for k in (1, 0))
    assert sum(good) / len(good) > sum(bad) / len(bad) + 1
    hard_rows = QUERIES["op3_importance_resampling"](spark, hard).collect()
    assert len(hard_rows) == len(hard_tables()["documents"]) and all(r["weight"] == 0 for r in hard_rows if r["n_features"] == 0)


def test_weights_and_keys_equal_plain_counts(spark):
    """The models counted word by word, the weight a sum over a text's features, and the k largest keys."""
    rng = random.Random(12)
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(60)] + [None, "", "one", "one", "x " * 500]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, prose(rng, 20)) for _ in range(20)] + [(7, prose(rng, 9)), (7, texts[7]), (7, texts[7])]
    labels = [(i, int(i % 3 > 0)) for i in range(50)] + [(None, 1), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = importance.resample(docs, spark.createDataFrame(labels, "doc_id long, quality int"), share=0.37).collect()
    good = {d for d, q in labels if q == 1 and d is not None}
    bags = [Counter(next(iter(importance.features([t])), (0, [], []))[1].tolist()) for _, t in rows]
    raw, target = Counter(), Counter()
    for (d, _), bag in zip(rows, bags):
        raw.update(bag)
        if d in good:
            target.update(bag)
    sums = [sum(c.values()) + importance.BUCKETS for c in (raw, target)]
    want = Counter()
    for (d, _), bag in zip(rows, bags):
        weight = sum(n * (math.log((target[b] + 1) / sums[1]) - math.log((raw[b] + 1) / sums[0])) for b, n in bag.items())
        want[d, sum(bag.values()), round(weight, 6)] += 1
    assert Counter((r["doc_id"], r["n_features"], round(r["weight"], 6)) for r in found) == want
    k = round(0.37 * len(rows))
    kept = [r["key"] for r in found if r["kept"]]
    assert len(kept) == k and sorted(kept) == sorted(r["key"] for r in found)[-k:]
    assert len({r["key"] for r in found if r["doc_id"] is None}) == 20  # each text draws for itself
    draws = [r["key"] - r["weight"] for r in importance.resample(docs.limit(0).unionAll(
        spark.range(4000).selectExpr("id AS doc_id", "'' AS text")), spark.createDataFrame(labels, "doc_id long, quality int")).collect()]
    below = sum(x < -math.log(math.log(2)) for x in draws) / len(draws)  # the median of Gumbel noise
    assert abs(below - 0.5) < 0.03


# op4


def test_roles_are_recovered(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    found = {(r["conv_id"], r["turn"]): r["role"] for r in transcripts.recovered(turns).collect()}
    true = {(r["conv_id"], r["turn"]): r["role"] for r in turns.collect()}
    # a third of the markers are lost, and where a turn without one begins has to be guessed
    assert sum(found.get(k) == r for k, r in true.items()) > 0.75 * len(true)


def brute_turns(rows, model):
    """conv_id, turn, role, n_lines, text of the turns of the best of all paths, by steps through every state of every line."""
    change, emission = map(transcripts.scaled, model)
    n, by = len(transcripts.STATES), defaultdict(list)
    for r in rows:
        by[r["conv_id"]].append(r)
    out = []
    for conv, lines in by.items():
        lines.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["line"], r["text"]))
        best = {n: (0, ())}
        for r in lines:
            tie = r["tie"] % 2**64
            following = {}
            for state in range(n):
                noise = ((tie >> (8 * state)) ^ (tie << (3 * state))) % 2**transcripts.NOISE
                ways = [(x + int(change[s, state]), path) for s, (x, path) in best.items() if change[s, state] > transcripts.NEVER]
                if ways:
                    x, path = max(ways)
                    following[state] = (x + int(emission[state, r["seen"]]) + noise, (*path, state))
            best = following
        _, path = max(best.values())
        for r, state in zip(lines, path):
            if state % 2 == 0 or not out or out[-1][0] != conv:
                out.append([conv, r["turn"], transcripts.ROLES[state // 2], 0, []])
            out[-1][3] += 1
            out[-1][4].append(r["shown"])
    return Counter((c, t, role, k, f"<|{role}|>\n" + "\n".join(x) + "\n<|end|>") for c, t, role, k, x in out)


def test_the_same_turns_at_every_block_size(spark):
    """Turns of many lines, which run on over the borders of small blocks, against steps through all paths."""
    rng = random.Random(9)
    rows = []
    for conv in range(6):
        for turn in range(25 if conv else 90):
            text = "\n".join(prose(rng, rng.randint(1, 9)) + rng.choice(["", "?"]) for _ in range(rng.choice([1, 1, 2, 5, 9])))
            rows.append((conv, turn, ("user", "assistant")[turn % 2], text))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = transcripts.transcripts(turns)
    seen = transcripts.observed(lines)
    model = transcripts.counted(seen)
    strip = F.regexp_replace("text", r"^\s*\W{0,3}[A-Za-z]{1,12}\W{0,3}:\s+", "")
    shown = F.when(transcripts.marker_of(F.col("text")) == "none", F.col("text")).otherwise(strip)
    known = seen.select("conv_id", "turn", "line", "text", "seen", shown.alias("shown"), F.xxhash64("turn", "line", "text").alias("tie"))
    want = brute_turns([r.asDict() for r in known.collect()], model)
    assert max(k for _, _, _, k, _ in want) > 9
    for block, few in ((1, 8), (2, 1024), (3, 4), (256, 1024), (10**6, 1024)):
        found = transcripts.parse(lines.drop("role"), model, block, few).collect()
        assert Counter((r["conv_id"], r["turn"], r["role"], r["n_lines"], r["rendered"]) for r in found) == want


def test_hard_conversations(spark, hard):
    rows = QUERIES["op4_transcripts"](spark, hard).collect()
    assert {r["conv_id"] for r in rows} == {None, *range(12)}


# op5


def test_listed_rules(spark, hard):
    rows = {r["page_id"]: r for r in QUERIES["op5_url_filter"](spark, hard).collect()}
    want = {0: "example.org/es/", 1: "example.org/en/1", 2: "com/de/", 3: None, 4: None, 5: None, 6: None, 7: None, 8: "com/fr/"}
    assert {k: rows[k]["rule"] for k in want} == want
    assert (rows[1]["host"], rows[1]["path"], rows[3]["host"], rows[5]["path"]) == ("example.org", "/en/19", "", "")
    assert rows[0]["verdict"] == "block" and rows[8]["verdict"] == "allow"


def test_mined_rules_block(spark):
    urls = [(i, f"http://{'bad' if i % 3 == 0 else 'good'}.net/{'ads' if i % 2 else 'news'}/{i}") for i in range(120)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not (i % 3 == 0 and i % 2)), 0) for i in range(90)], "doc_id long, quality int, toxic int")
    rows = url_filter.judge(pages, labels, min_support=0.05, min_confidence=0.9).collect()
    assert {r["page_id"] for r in rows if r["verdict"] == "block"} == {i for i in range(120) if i % 3 == 0 and i % 2}


def test_mined_rules_equal_enumerated_ones(spark):
    """The surest of all sets of tokens that enough bad pages have, for every URL; tokens that go together, hot ones."""
    rng = random.Random(13)
    urls = []
    for i in range(400):
        host = rng.choice(["a.net", "b.net", "www.a.net", "c.org", "d.e.net"])
        path = "/".join(rng.choice("pqr") for _ in range(rng.randint(0, 2)))
        query = "&".join(sorted(rng.sample(["u=1", "v=2", "w"], rng.randint(0, 2))))
        urls.append((i, f"http://{host}/{path}{'?' + query if query else ''}"))
    bad = {i for i, u in urls if ("a.net" in u and "u=" in u and rng.random() < 0.9) or ("/q" in u and "w" in u.split("?")[-1]) or rng.random() < 0.1}
    labels = [(i, int(i not in bad), 0) for i in range(300)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    found = url_filter.judge(pages, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rules=[], min_confidence=0.4)
    held = {r["page_id"]: r["tokens"] for r in url_filter.with_parts(pages).collect()}
    sets = defaultdict(lambda: [0, 0])
    for i in range(300):
        for k in range(1, len(held[i]) + 1):
            for x in combinations(sorted(held[i]), k):
                sets[x][0] += 1
                sets[x][1] += i in bad
    total_bad = sum(i in bad for i in range(300))
    sure = max(0.4, 1.5 * total_bad / 300)
    rules = {frozenset(x): b / n for x, (n, b) in sets.items() if b >= 5 and b / n >= sure - 1e-12}
    assert len(rules) > 20
    for r in found.collect():
        best = max((c for x, c in rules.items() if x <= set(held[r["page_id"]])), default=None)
        assert (r["mined_confidence"] is None) == (best is None), r
        assert best is None or abs(r["mined_confidence"] - best) < 1e-12
        assert r["verdict"] == ("block" if best else "allow")


def test_rules_on_deep_parts_of_long_urls(spark):
    """The bad pages tell themselves by the sixth path part, host level or query name only; traps nest deep."""
    urls = []
    for i in range(120):
        host, path, query = ["a"] * 6, ["p"] * 7, [f"q{j}=1" for j in range(5)]
        if i % 3 == 0:
            (host, path, query)[i // 3 % 3].__setitem__((0, 6, 4)[i // 3 % 3], ("ads", "ads", "ads=1")[i // 3 % 3])
        urls.append((i, f"http://{'.'.join(host)}/{'/'.join(path)}?{'&'.join(query)}"))
    urls += [(200 + i, "http://a.a/" + "t/" * (10 + i % 30)) for i in range(60)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = [(i, int(i % 3 > 0), 0) for i in range(90)] + [(200 + i, 1, 0) for i in range(60)]
    rows = url_filter.judge(pages, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {r["page_id"] for r in rows if r["verdict"] == "block"} == {i for i in range(120) if i % 3 == 0}


# op6


def test_spans_are_cut(spark, hard, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", 7)
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)  # the other way beyond the bound
    assert differences(QUERIES["op6_decontamination"](spark, hard), connect(hard), SQL["op6_decontamination"]) == []
    docs, bench = (spark.read.parquet(f"{hard}/{x}.parquet") for x in ("documents", "benchmark"))
    left = decontamination.decontaminate(docs, bench, "spans")
    assert left.count() == docs.count() and left.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in left.filter("text like '%endoftext%'").collect()}
    assert all("\n \n<|endoftext|>" in x for x in text.values()) and text
    assert left.join(docs, "doc_id").filter(left.text.isNull()).count() > 0
    clean = decontamination.report(left.select("doc_id", "text"), bench).filter("contaminated").count()
    assert clean == 0


def test_items_of_one_text_count_for_the_broadcast(spark, monkeypatch):
    text = "one two three four five six seven eight nine ten"
    bench = spark.range(5000).selectExpr("id AS item_id", f"'{text}' AS text")
    docs = spark.createDataFrame([(1, f"so {text} it is"), (2, "none of it")], "doc_id long, text string")
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 10_000)  # the window alone is 48 bytes
    found = decontamination.report(docs, bench)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in found.collect()} == {1: (10, 5000), 2: (0, 0)}


# op7


def brute_passages(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        runs = []
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        ends = [0, *(e for _, e in runs)]
        left = b"".join(b[a:z] for a, z in zip(ends, [*(s for s, _ in runs), len(b)]))
        out.append((d, len(b), len(b) - len(left), len(runs), hashlib.sha256(left).hexdigest()))
    return Counter(out)


CUT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def cut_rows(df):
    return Counter(tuple(r[c] for c in CUT) for r in df.collect())


def brute_word_spans(rows, length):
    """The maximal runs of words that windows of ``length`` words cover, of those that occur again."""
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for _, t in rows]
    windows = [[tuple(w[i : i + length]) for i in range(len(w) - length + 1)] for w in words]
    seen = Counter(x for w in windows for x in w)
    out = []
    for (d, _), mine in zip(rows, windows):
        starts = [i for i, x in enumerate(mine) if seen[x] > 1]
        out.append((d, sum(k == 0 or starts[k - 1] + length < i for k, i in enumerate(starts))))
    return Counter(out)


def test_passages_equal_brute_force(spark, hard, docs, monkeypatch):
    given = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()
    for folder, rows in ((hard, docs), (SMALL, given)):
        found = QUERIES["op7_repeated_passages"](spark, folder).cache()
        assert cut_rows(found) == brute_passages(rows, 400)
        spans = Counter((r["doc_id"], r["n_word_spans"]) for r in found.collect())
        assert spans == brute_word_spans(rows, 51)
        assert found.filter("repeats <> (n_spans + n_word_spans > 0)").isEmpty()


def test_passages_of_periods_and_cuts(spark, monkeypatch):
    """Repeats of 399 to 430 bytes at all offsets; long texts that are cut into pieces in the tasks."""
    rng = random.Random(5)
    part = prose(rng, 300).encode()[:430].decode(errors="ignore")
    texts = [prose(rng, 20 + k) + part[k : len(part) - j] + prose(rng, 30) for k in range(0, 32, 5) for j in (0, 9, 20)]
    texts += ["abcabd" * 400, "q" * 399, prose(rng, 40) + "q" * 400, prose(rng, 60000) + part, part]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert cut_rows(substrings.report(df)) == brute_passages(list(enumerate(texts)), 400)


def brute_word_passages(rows, length):
    """What is left of each text without the passages of ``length`` words that occur again."""
    seen, found = Counter(), []
    for _, t in rows:
        at = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())]
        words = [(t or "").encode()[a:z].lower() for a, z in at]
        found.append((at, [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]))
        seen.update(found[-1][1])
    out = []
    for (d, t), (at, windows) in zip(rows, found):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i, w in enumerate(windows):
            if seen[w] > 1:
                gone[at[i][0] : at[i + length - 1][1]] = b"\1" * (at[i + length - 1][1] - at[i][0])
        out.append((d, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    return Counter(out)


def test_passages_of_words_equal_brute_force(spark, docs):
    """Repeats of 49 to 62 words at all offsets, long texts, periods, white space that differs."""
    rng = random.Random(6)
    part = prose(rng, 62).split(" ")
    rows = list(docs)
    for k in range(12):
        for j in (0, 1, 2):
            rows.append((1000 + 3 * k + j, f"{prose(rng, 20 + k)} {' '.join(part[k : len(part) - j])}\n{prose(rng, 30)}"))
    rows += [(2000, " \n ".join(part).upper()), (2001, "a b c " * 300), (2002, f"{prose(rng, 9000)} {' '.join(part)}"), (2003, "x " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = substrings.report(df, (substrings.WORDS,)).select("doc_id", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == brute_word_passages(rows, 51)


def test_pipeline_cuts_short_passages_of_over_50_words(spark):
    rng = random.Random(7)
    words = [rng.choice("abcdefgh") + rng.choice("abcdefgh") * (i % 3) for i in range(51)]
    rare, long = " ".join(words), "q" * 200 + " " + "z" * 250
    texts = [f"{prose(rng, 30)} {x} {prose(rng, 30)}" for x in (rare, rare, " ".join(words[:50]), long, long)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    left = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["repeated passages"](spark, docs, "").collect()}
    assert len(rare) < 400 and all(rare not in left[i] and len(left[i]) == len(texts[i]) - len(rare) for i in (0, 1))
    assert left[2] == texts[2] and all(long not in left[i] for i in (3, 4))


# op8


@pytest.mark.parametrize("shift", [0.0, 4.0])
def test_the_gradient_of_the_risk_equals_differences(shift):
    """On either side of where the second term of the risk turns negative."""
    rng = np.random.default_rng(3)
    positive = np.arange(40) < 15
    z = rng.normal(size=40) + np.where(positive, shift, -shift)
    prior = 0.45
    value, gradient = toxicity.risk(z, positive, prior)
    loss = np.logaddexp(0, z)
    rest = loss[~positive].mean() - prior * loss[positive].mean()
    assert (rest < 0) == (shift > 0)
    assert abs(value - (-rest if rest < 0 else prior * np.logaddexp(0, -z[positive]).mean() + rest)) < 1e-12
    for i in range(40):
        step = np.where(np.arange(40) == i, 1e-6, 0)
        slope = (toxicity.risk(z + step, positive, prior)[0] - toxicity.risk(z - step, positive, prior)[0]) / 2e-6
        assert abs(slope - gradient[i]) < 1e-8


def test_held_out_toxicity(spark, hard):
    rows = {r["doc_id"]: r for r in QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    labels = duckdb.sql("select doc_id, toxic from '/root/testdata/sf0.1/labels.parquet' where toxic is not null").fetchall()
    test = [(rows[d]["predicted"], t) for d, t in labels if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(rows[d]["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, _ in labels)
    hit = sum(p and t for p, t in test)
    assert hit > 0.9 * sum(t for _, t in test) and hit > 0.8 * sum(p for p, _ in test)
    assert all(0 <= r["score"] <= 1 for r in QUERIES["op8_toxicity"](spark, hard).collect())


def test_no_positive_example(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    labels = spark.read.parquet(f"{hard}/labels.parquet").filter("toxic = 0")
    assert {r["predicted"] for r in toxicity.judge(docs, labels).collect()} == {0}


def test_an_id_that_many_rows_share_is_learnt_once(spark):
    rows = [(0, f"idiot {i}") for i in range(3000)] + [(i, f"idiot {i}" if i % 9 == 0 else f"calm {i}") for i in range(1, 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(900)], "doc_id long, toxic int")
    learnt, prior = toxicity.sample(docs, labels)
    assert not learnt.duplicated(["positive", "doc_id"]).any() and 0.1 < prior < 0.12
    want = {r["doc_id"]: r["score"] for r in toxicity.judge(docs.repartition(1), labels).collect()}
    got = {r["doc_id"]: r["score"] for r in toxicity.judge(docs.repartition(7, "text"), labels).collect()}
    assert want.keys() == got.keys() and all(abs(want[d] - got[d]) < 1e-9 for d in want if d)
    assert min(got[i] for i in range(9, 900, 9)) > max(got[i] for i in range(1, 900) if i % 9)


# op9


def brute_components(rows, percent, size):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        k = min(size, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x])
        for x in s:
            holders[x].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[top(i)] = top(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[top(i)].append(d)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return Counter((d, len(s), least[top(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def test_near_copies_are_not_copied_to_every_pivot(spark):
    """Each link is with a pivot, met in a region, or between texts that a pivot connects; few rows are replicated."""
    rng = random.Random(5)
    base, fresh = list(range(300)), iter(range(1000, 10**6))
    rates = [(0.01, 0.02, 0.04, 0.07)[i % 4] for i in range(159)]
    sets = [set(base)] + [{next(fresh) if rng.random() < rate else x for x in base} for rate in rates]
    # and some that are linked with few
    sets += [{next(fresh) if rng.random() < 0.02 else x for x in sets[rng.randrange(80, 160)]} for _ in range(40)]
    data = [(7, i, len(s), sorted(s)) for i, s in enumerate(sets)]
    rows = spark.createDataFrame(data, "region long, cls long, n long, shingles array<long>")
    sizes = spark.createDataFrame([(7, len(sets), sum(map(len, sets)), 0)], "region long, members long, shingles_in long, least long")
    links, inside, crowded = jaccard_join.split(rows, sizes, 85, 0, 3 * F.col("members"))
    assert crowded.count() == 0
    _, none, crowded = jaccard_join.split(rows, sizes, 85, 0, F.lit(0))  # counted before any row is made
    assert none.count() == 0 and [r.region for r in crowded.collect()] == [7]
    met = {(r.new, r.cls) for r in inside.collect()}
    to_pivots = {(r.a, r.b) for r in links.collect()}
    assert 0 < len(met) < 2 * len(sets)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in to_pivots:
        root[find(a)] = find(b)
    of = defaultdict(set)
    for new, cls in met:
        of[cls].add(new)
    linked = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 100 * len(a & b) >= 85 * len(a | b)]
    assert len(linked) > 2000 and to_pivots
    assert not [(i, j) for i, j in linked if find(i) != find(j) and not of[i] & of[j]]


@pytest.mark.parametrize(("percent", "size", "region"), [(85, 4, 400_000), (80, 5, 400_000), (85, 4, 600)])
def test_components_equal_brute_force(spark, hard, docs, percent, size, region):
    df = spark.read.parquet(f"{hard}/documents.parquet")
    got = jaccard_join.report(df, percent=percent, words=size, region=region).collect()
    assert Counter(map(tuple, got)) == brute_components(docs, percent, size)


def test_regions_split_by_pivots_and_in_blocks(spark, monkeypatch):
    """A chain of texts that differ a little each, so one region holds them all."""
    rng = random.Random(9)
    words, texts = prose(rng, 150).split(" "), []
    for i in range(150):
        words[(7 * i) % 150] = f"w{i}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_components(rows, 85, 4)
    assert Counter(map(tuple, jaccard_join.report(df, region=2000, task=2000).collect())) == want
    assert Counter(map(tuple, jaccard_join.report(df, region=2000).collect())) == want  # joined whole where pivots do not help
    with monkeypatch.context() as m:
        m.setattr(jaccard_join, "PIVOTS", 0)  # as if none was drawn
        assert Counter(map(tuple, jaccard_join.report(df, region=2000, task=2000).collect())) == want
    monkeypatch.setattr(jaccard_join, "MOST_SPLITS", 0)
    assert Counter(map(tuple, jaccard_join.report(df, region=2000, task=2000).collect())) == want


def brute_groups(texts, percent, size):
    """The texts as groups of linked ones."""
    ids = [(i, t) for i, t in enumerate(texts)]
    groups = defaultdict(set)
    for (i, _, least), k in brute_components(ids, percent, size).items():
        assert k == 1
        groups[least].add(texts[i])
    return list(groups.values())


def test_one_text_of_each_component_whatever_its_id(spark):
    """Documents without an id, and unlinked ones that share an id: each group keeps one text."""
    rng = random.Random(21)
    rows, kinds = [], (None, 4, 5, None)
    for k in range(24):
        text = prose(rng, 90)
        for copy in range(1 + k % 3):
            rows.append((kinds[k % 4] if copy == 0 or k % 2 else 100 + k, text + f" end{copy}"))
    rows += [rows[0], (None, None), (None, ""), (4, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    left = [t for (_, t) in jaccard_join.deduplicated(docs, percent=80, words=5).collect()]
    groups = brute_groups(sorted({t for _, t in rows if t}), 80, 5)
    assert len(groups) == 24 and all(sum(t in g for t in left) == 1 for g in groups)
    assert len(left) == len(groups) + 2
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    assert sorted(t or "" for (_, t) in stage(spark, docs, "").collect()) == sorted(t or "" for t in left)


def test_connected_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(60)] + [(100 + rng.randint(0, 50), 100 + rng.randint(0, 50)) for _ in range(40)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    group = {x: {x} for p in pairs for x in p}
    for a, b in pairs:
        both = group[a] | group[b]
        for x in both:
            group[x] = both
    assert got == {x: min(g) for x, g in group.items() if len(g) > 1}


# op10


@pytest.mark.parametrize("folder", ["hard", SMALL])
def test_packing(spark, hard, folder):
    folder = hard if folder == "hard" else folder
    rows = [r.asDict() for r in QUERIES["op10_packing"](spark, folder).collect()]
    path = "/*.parquet" if folder == hard else ""
    texts = duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet{path}'").fetchall()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = defaultdict(list)
    for d, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        whole[d].append(ids)
    sequences = defaultdict(list)
    tokens = Counter()
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        tokens[r["doc_id"]] += r["length"]
        a, n = r["start"], r["length"]
        assert any(
            len(ids) == r["doc_tokens"] and zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a : a + n])) == r["ids_crc32"]
            for ids in whole[r["doc_id"]]
        )
    assert tokens == Counter({d: sum(map(len, x)) for d, x in whole.items()})
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(tokens.values())
    assert len(sequences) * 2048 - total < 0.02 * total + 2048


def test_differencing_keeps_the_lengths():
    rng = random.Random(2)
    for n in (0, 1, 2, 50, 400):
        lengths = sorted((rng.randint(1, 2047) for _ in range(n)), reverse=True)
        windows = packing.windows_of(lengths, 2048)
        assert sorted(i for w in windows for i in w) == list(range(n))
        assert all(sum(lengths[i] for i in w) <= 2048 for w in windows)
