"""Line deduplication, spelling variants and the Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tablewright.llm import line_dedup, merkle, spelling
from tablewright.llm.queries import QUERIES
from tests.llm.test_operators import SMALL, docs, folders, hard, prose  # noqa: F401

SPACE = " \t\n\x0b\x0c\r"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def rows_of(folder, columns):
    path = f"{folder}/documents.parquet" + ("" if folder == SMALL else "/*.parquet")
    return duckdb.sql(f"select {columns} from '{path}'").fetchall()


# --- lines ------------------------------------------------------------------------------


def kept_lines(docs, least=20, documents=3):
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key := lowered(line.strip(SPACE))) >= least:
                holders[key].add(doc_id)
    keeper = {k: max(x for x in v if x is not None) for k, v in holders.items() if len(v) >= documents}
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        out.append((doc_id, lines, [keeper.get(lowered(x.strip(SPACE)), doc_id) == doc_id for x in lines]))
    return out


@pytest.mark.parametrize("where", ["hard", "given"])
def test_lines_equal_brute_force(spark, hard, where):  # noqa: F811
    folder = hard if where == "hard" else SMALL
    want = []
    for doc_id, lines, keep in kept_lines(rows_of(folder, "doc_id, text")):
        left = "\n".join(x for x, k in zip(lines, keep) if k)
        want.append((doc_id, len(lines), len(lines) - sum(keep), hashlib.sha256(left.encode()).hexdigest()))
    got = [tuple(r) for r in QUERIES["op11_line_dedup"](spark, folder).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(x[2] for x in want) > 0


def line_table(spark):
    """One line that a third of all rows carry, a long text, a text of shared lines alone, null and shared ids."""
    hot, warm = "This line stands in every third document", "Another line that is shared by some"
    texts = [f"{hot if i % 3 == 0 else ''}\nown line number {i} of the table\n{warm if i % 50 == 0 else 'x'}" for i in range(900)]
    long = "\n".join([f"line {i % 700} of the long document" if i % 2 else warm.upper() for i in range(20000)])
    rows = list(enumerate(texts)) + [(2000, long), (2001, long), (2002, f"{long}\n"), (2003, hot), (2004, warm), (None, hot), (5, warm)]
    rows += [(3000, hot + "\n" + warm)] * 40
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_bitmaps_and_texts_of_hot_lines(spark):
    rows, df = line_table(spark)
    want = kept_lines(rows)
    got = line_dedup.keep_bitmaps(df).collect()
    found = []
    for x in got:
        keep = [True] * x["n_lines"]
        for word, bits in x["keep"]:
            assert bits != -1
            for i in range(64):
                if 64 * word + i < len(keep):
                    keep[64 * word + i] = bool(bits >> i & 1)
        found.append((x["doc_id"], tuple(keep)))
        assert x["n_dropped"] == keep.count(False)
    assert Counter(found) == Counter((d, tuple(k)) for d, _, k in want)
    texts = Counter((d, "\n".join(x for x, y in zip(lines, k) if y)) for d, lines, k in want)
    assert Counter((r["doc_id"], r["text"]) for r in line_dedup.deduplicated(df).collect()) == texts


def test_lines_of_a_null_text_and_other_columns(spark):
    df = spark.createDataFrame([(1, None, "a", 3, 7), (2, "", "b", 0, 8)], "doc_id long, text string, keep string, n_chars long, row int")
    assert line_dedup.deduplicated(df).columns == df.columns
    assert {(r["doc_id"], r["text"], r["keep"]) for r in line_dedup.deduplicated(df).collect()} == {(1, None, "a"), (2, "", "b")}
    assert {(r["doc_id"], r["n_lines"], r["n_dropped"], len(r["keep"])) for r in line_dedup.keep_bitmaps(df).collect()} == {(1, 1, 0, 0), (2, 1, 0, 0)}


# --- words ------------------------------------------------------------------------------


def counted(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def related(words):
    """word, form, root, n, n_near, form_n by comparing all pairs."""
    near = defaultdict(list)
    by_size = defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    for size, ws in by_size.items():
        for i, a in enumerate(ws):
            for b in ws[i + 1 :] + by_size.get(size + 1, []):
                if one_edit(a, b):
                    near[a].append(b)
                    near[b].append(a)
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 10 * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items())


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.parametrize("where", ["hard", "given"])
def test_spelling_equals_brute_force(spark, hard, where):  # noqa: F811
    folder = hard if where == "hard" else SMALL
    want = related(counted(rows_of(folder, "doc_id, text")))
    got = QUERIES["op12_spelling_variants"](spark, folder).select(COLUMNS)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(want) > 5


@pytest.mark.parametrize("limit, task", [(25, 200), (16384, 20000)])
def test_groups_of_any_limit_give_the_same(spark, limit, task):
    """Words of one stem, so that one group holds nearly all, and very long ones."""
    rng = random.Random(4)
    words = {}
    for _ in range(500):
        w = list("information" if rng.random() < 0.7 else "informations")
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w))
            w[i : i + rng.randint(0, 1)] = rng.choice(["a", "b", "é", "", "ÿ"])
        words["".join(w)] = rng.choice([2, 3, 40, 500, 9000])
    for k in range(7, 14):
        words["a" * k] = 2 * 11 ** (k % 4)
    words |= {"b" * 3000: 30, "b" * 3001: 2, "b" * 1500 + "c" + "b" * 1500: 2, "c" + "b" * 3000: 400}
    words = {w: n for w, n in words.items() if len(w) >= 7}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = sorted(tuple(r) for r in spelling.variants(df, limit=limit, task=task).select(COLUMNS).collect())
    assert got == related(words)
    groups = spelling.grouped(df, limit=limit).filter("size - head - tail > 1").groupBy(*spelling.KEYS).count()
    assert (groups.agg(F.max("count")).first()[0] or 0) <= limit


def test_chains_end_at_the_most_frequent(spark):
    chain = [("abcdefg" + "z" * k, 2 * 10**k) for k in range(9)]
    got = {r["word"]: r["root"] for r in spelling.variants(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert set(got.values()) == {chain[-1][0]} and len(got) == 9


# --- trees ------------------------------------------------------------------------------


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def way_up(tree, i):
    for nodes in tree[:-1]:
        a = i - i % 3
        yield nodes[a:i], nodes[i + 1 : a + 3]
        i //= 3


def trees(docs):
    def leaf(row):
        return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)

    by = defaultdict(list)
    for row in docs:
        by[row[1]].append(row)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for rows in by.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    tree = {s: levels([leaf(r) for r in by[s]]) for s in sources}
    above = levels([tree[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, row in enumerate(by[s]):
            path = [*way_up(tree[s], i), *way_up(above, k)]
            other = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                other = (*row[:4], row[4].replace("\n", ""))
            root = leaf(other)
            for a, b in path:
                root = digest([*a, root, *b])
            proof = digest(x for a, b in path for x in a + b)
            out.append((row[0], leaf(row), tree[s][-1][0], above[-1][0], proof, root, root == above[-1][0]))
    return out


FIELDS = "doc_id, source, lang, n_chars, text"
NODES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("where", ["hard", "given"])
def test_manifest_equals_brute_force(spark, hard, where):  # noqa: F811
    folder = hard if where == "hard" else SMALL
    want = trees(rows_of(folder, FIELDS))
    got = [tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, folder).select(NODES).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {x[-1] for x in want} == {True, False}


def test_a_tree_of_several_buckets(spark):
    """One source with most rows, many of one row, so that both trees pass more than one bucket of levels."""
    rows = [(i, "big", "en", i, f"text\n{i}") for i in range(1600)] + [(i, f"s{i}", None, 0, None) for i in range(800)]
    rows += [(7, "big", "en", 7, "text\n7")] * 3 + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    got = [tuple(r) for r in merkle.report(df).select(NODES).collect()]
    assert sorted(got, key=repr) == sorted(trees(rows), key=repr)


def test_paths_tell_a_changed_leaf(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for x in merkle.manifest(df).collect():
        assert merkle.folded(x["leaf"], x["path"]) == x["root"] != merkle.folded(x["root"], x["path"])
