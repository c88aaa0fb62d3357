"""Vector codes, the prefix trie and the toxicity machine: brute-force twins, held-out accuracy, edges."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cohortlens.llm import prefixtrie, stringkernel, vectorcode
from cohortlens.llm.common import table
from tests.conftest import SMOKE

WORD = re.compile("[^\x20\x09-\x0d]+")


# ------------------------------------------------------------------ 11
VECTORS = "vec_id long, embedding array<float>, label int, code string, points int"


def brute_codes(rows):
    """Plain integer k-means over (vec_id, vector, label) rows in Python integers."""
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // 8))
    cell = lambda v: [int(np.clip(np.floor(float(np.float32(x)) * 4096), -2.0 ** 47, 2.0 ** 47)) for x in v] + [0] * (8 * width - len(v))
    pts = [cell(v) for _, v, _ in kept]
    seeds = []
    for i in sorted({i for i, _, _ in kept if i is not None})[:16]:
        seeds.append(min(p for (j, _, _), p in zip(kept, pts) if j == i))
    codes, errors, books = [[] for _ in kept], [0] * len(kept), []
    for part in range(8):
        cut = [p[part * width:(part + 1) * width] for p in pts]
        book = [s[part * width:(part + 1) * width] for s in seeds]
        near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
        for _ in range(6):
            own = [near(x)[1] for x in cut] if book else []
            for k in range(len(book)):
                mine = [x for x, o in zip(cut, own) if o == k]
                if mine:
                    book[k] = [sum(col) // len(mine) for col in zip(*mine)]
        for i, x in enumerate(cut if book else []):
            d, k = near(x)
            codes[i].append(f"{k:02x}")
            errors[i] += d
        books += [v for e in book for v in e]
    sha = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    groups = {}
    for (_, _, g), e in zip(kept, errors):
        groups[g] = groups.get(g, 0) + e
    return sorted((i if i is not None else -1, "".join(c), min(e, 2 ** 63 - 1), min(groups[g], 2 ** 63 - 1), sha)
                  for (i, _, g), c, e in zip(kept, codes, errors))


def run_codes(spark, rows):
    df = spark.createDataFrame([(i, v, g, "x", 1) for i, v, g in rows], VECTORS)
    return sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["code"], r["error"], r["label_error"], r["codebooks_sha256"])
                  for r in vectorcode.compress(df).collect())


def test_codes_equal_plain_k_means(spark):
    r = np.random.default_rng(3)
    centres = r.normal(size=(5, 24))
    rows = [(i, [float(x) for x in centres[i % 5] + r.normal(size=24) * 0.05], i % 3) for i in range(300)]
    rows += [(400 + i, rows[7][1], None) for i in range(150)]                # a hot vector
    assert run_codes(spark, rows) == brute_codes(rows)


def test_codes_edges(spark):
    r = np.random.default_rng(4)
    vec = lambda n: [float(x) for x in r.normal(size=n)]
    rows = [(5, vec(16), 1), (5, vec(16), 1), (5, None, 1), (6, [1.0, None], 1), (7, [float("nan")] * 16, None), (8, [float("inf")] * 16, 2),
            (None, vec(16), None), (9, [], None), (10, vec(9), 2), (11, [0.0] * 16, None), (11, [0.0] * 16, None), (-3, [1e30, -1e30] * 8, 4)]
    assert run_codes(spark, rows) == brute_codes(rows)
    nobody = [(None, vec(8), 1), (1, None, 1)]
    assert run_codes(spark, nobody) == brute_codes(nobody)
    assert run_codes(spark, [(1, None, 1)]) == []


def test_tree_caches_and_owners():
    r = np.random.default_rng(5)
    x = np.concatenate([(r.normal(size=(900, 4)) * 300).astype(np.int64), np.full((200, 4), 77)])
    raw = vectorcode._unpack(vectorcode._pack(vectorcode.Tree(x).packed()))
    assert sorted(raw["order"].tolist()) == list(range(len(x))) and (x[raw["order"]] == raw["points"]).all()
    left, right, lo, hi = raw["tree"]
    for n in range(len(lo)):
        inside = raw["points"][lo[n]:hi[n]]
        assert (inside.sum(axis=0) == raw["sums"][n]).all()
        assert np.sqrt(((inside - raw["pivot"][n]) ** 2).sum(axis=1)).max() <= raw["radius"][n] * (1 + 1e-9) + 1e-9
    entries = x[:16]
    d = ((raw["points"][:, None] - entries[None]) ** 2).sum(axis=2)
    assert (vectorcode._owners(raw, entries) == d.argmin(axis=1)).all()
    assert any(node >= 0 for node, *_ in vectorcode.assign(raw, entries))


# ------------------------------------------------------------------ 12
CONVERSATIONS = "conv_id long, turn int, role string, text string, depth int, n string"


def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0), role, hashlib.sha256(text.encode()).hexdigest(), text))
    own = {c: [(x[1], x[3]) for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - int(np.fmod(c, 20)), [])
        built[c] = tuple(base[:h] + turns[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    kids, credit = {}, {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
        credit[p] = (len(nodes[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0

    def below(p):
        got = [below(k) for k in kids.get(p, [])]
        return (sum(x[0] for x in got) or 1, credit[p] + sum(x[1] for x in got))

    out = []
    for p, members in nodes.items():
        leaves, saved = below(p)
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids.get(p, [])), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run_trie(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], CONVERSATIONS)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[c] for c in columns) for r in prefixtrie.trie(df, **kw).collect()), key=repr)


def conversations(n=160, seed=9):
    r, rows = random.Random(seed), []
    for c in range(n):
        same = c % 3 == 0                                     # a third are copies of one conversation
        for t in range(4 if same else r.randrange(1, 6)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"hello turn {t}" if same or (t == 0 and c % 2) else f"words {r.randrange(4)} here"))
    return rows


@pytest.mark.parametrize("shard_rows", [1, 30, 200_000])
def test_trie_equals_brute_force(spark, shard_rows):
    rows = conversations()
    assert run_trie(spark, rows, shard_rows=shard_rows) == brute_trie(rows)


def test_trie_edges(spark):
    rows = [(20, None, None, "first"), (20, 1, "user", None), (20, 1, "assistant", ""), (20, 1, "user", "x"), (20, 1, "user", "x"), (None, 1, "user", "lost"),
            (21, 0, "user", "é " * 50_000), (-7, 3, "user", "negative"), (-20, 0, "user", "base"), (22, 0, "", "a"), (47, 1, "user", "no base"),
            (48, 1, None, None), (49, 5, "user", "only"), (2_000_000_001, 1, "user", "big id")]
    assert run_trie(spark, rows) == brute_trie(rows)
    assert run_trie(spark, [(None, 1, "user", "lost")]) == []


def test_a_conversation_longer_than_a_partition(spark):
    rows = [(40, t, "user", f"t{t % 7}") for t in range(3000)] + [(41, t, "user", f"t{t % 7}") for t in range(2990)]
    got = run_trie(spark, rows, shard_rows=2000)
    h = zlib.crc32(b"41") % 4
    assert len(got) == 3001 and got == brute_trie_long(rows, h)


def brute_trie_long(rows, h):
    """The chain that conversations 40 and 41 share: 41 starts as 40 does and ends ten turns earlier."""
    shared, words = 2990, 1
    h40 = zlib.crc32(b"40") % 4
    assert h40 >= 0 and h >= 0                                # turn texts repeat alike, so both heads change nothing
    none, one = hashlib.sha256(b"").hexdigest(), lambda c: hashlib.sha256(str(c).encode()).hexdigest()
    out = []
    for d in range(3001):
        n = 2 if d <= shared else 1
        saved = max(0, shared - max(d, 1) + 1) * words
        out.append((40, d, 40 if d else None, n, 0 if d == 3000 else 1, 1, saved, one(41) if d == shared else one(40) if d == 3000 else none))
    return sorted(out, key=repr)


def test_slots_are_minimal_and_verified():
    r = np.random.default_rng(6)
    a, b = r.integers(-2 ** 62, 2 ** 62, 5000), r.integers(-2 ** 62, 2 ** 62, 5000)
    depth = r.integers(1, 9, 5000)
    t = prefixtrie.SlotTable(depth, a, b)
    assert sorted(t.find(depth, a, b).tolist()) == list(range(5000))
    assert (t.find(depth + 1, a, b) == -1).all() and (t.find(depth, b, a) == -1).all()


# ------------------------------------------------------------------ 13
INSULTS = ["grumblok", "snarvex", "plodwick"]


def toxic_corpus(n=900, seed=2):
    r = random.Random(seed)
    syllables = ["an", "the", "on", "re", "ti", "sh", "er", "ing", "ha", "ou", "le", "st"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(r.randrange(15, 90))]
        if i % 4 == 0:
            for _ in range(2):
                w.insert(r.randrange(len(w)), r.choice(INSULTS))
        docs.append((i, ". ".join(" ".join(w[k:k + 9]) for k in range(0, len(w), 9)), "en", "a"))
        labels.append((i, 1, int(i % 4 == 0)))
    return docs, labels


@pytest.fixture(scope="module")
def machine(spark):
    docs, labels = toxic_corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, score string")
    return stringkernel.fit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")), docs


def scores(model, texts):
    return model.scores(pa.array(texts, pa.string()))


def test_toxicity_held_out_and_obfuscated(spark, machine):
    model, docs = machine
    held = [(t, i % 4 == 0) for i, t, _, _ in docs if zlib.crc32(str(i).encode()) % 3 == 1]
    s = scores(model, [t for t, _ in held]) >= stringkernel.THRESHOLD
    truth = np.array([y for _, y in held])
    assert s[truth].mean() >= 0.95 and s[~truth].mean() <= 0.02
    clean = "an the on reti shering haou lest an the on"
    changed = ["g r u m b l o k", "grum.blok", "GRUM-BLOK", "snarrvex", "s.n.a.r.v.e.x", "plodxwick", "plo dwick"]
    got = scores(model, [f"{clean} {x} {clean}" for x in changed])
    assert (got > scores(model, [f"{clean} {clean}"])[0]).all() and (got >= stringkernel.THRESHOLD).mean() >= 0.7


def test_folded_table_equals_the_kernel(machine):
    marks = stringkernel.Landmarks.of(["grumblok", "snarvex", "theing"])
    w = np.arange(1.0, marks.white.shape[1] + 1)
    model = stringkernel.Model(marks.table(w), 0.25)
    text = "grumb snar"
    points, _ = stringkernel._rows(pa.array([text]))
    starts, value = model.passages(points)
    for k, v in zip(starts, value):
        own = (" " + text + " " * 30)[k:k + stringkernel.WINDOW + 1]
        z = marks.rows([own])[0] * stringkernel._scale(np.float64(len(own))) / stringkernel._scale(np.float64(stringkernel.WINDOW))
        assert abs(z @ w + 0.25 - v) < 0.35 * max(1.0, abs(v))        # the passage's last subsequences run over its end


def test_toxicity_edges(spark, machine):
    model, docs = machine
    long = "the on re " * 30_000
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "12 !!"), (5, long), (5, long + "grumblok"), (None, "the snarvex on"), (6, "x" * 300_000), (7, "漢字 かな ünï")]
    df = spark.createDataFrame([(i, t, 0.5, 9) for i, t in rows], "doc_id long, text string, score double, predicted int")
    got = stringkernel.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    empties = {r["score"] for r in got if r["doc_id"] in (1, 2, 3, 4)}
    assert len(empties) == 1
    fives = sorted(r["score"] for r in got if r["doc_id"] == 5)
    assert fives[0] < 0.7 <= fives[1]
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [True]
    assert stringkernel.score(df.where("1 = 0"), model).count() == 0


def test_toxicity_without_both_classes(spark):
    d = spark.createDataFrame([(i, "the on re") for i in range(30)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(i, 0) for i in range(30)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    assert {r["score"] for r in stringkernel.toxicity(d, none).collect()} == {0.0}
    assert {r["score"] for r in stringkernel.toxicity(d, one).collect()} == {0.0}


def test_smoke_tables(spark):
    got = stringkernel.toxicity(table(spark, SMOKE, "documents"), table(spark, SMOKE, "labels"))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 200


def test_mixing_broadcasts_no_table_of_the_corpus(spark):
    """Files of a few numbers a row look small enough to broadcast at any size; blocks and rows meet by sorting."""
    from cohortlens.llm import mix
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    for out in (mix.mix(docs), mix.mixed_documents(docs)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
