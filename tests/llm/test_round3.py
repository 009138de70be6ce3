"""License scan, hard negatives and spelling variants against brute force, and on edge rows."""
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from hrlens.llm import hardneg, licenses, queries, variants
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# licenses

def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def blocks_by_hand(text, templates, percent):
    """Every block of every template, by counting."""
    words, out = license_words(text), []
    for t, (label, notice) in enumerate(templates):
        want = Counter(license_words(notice))
        m, half = sum(want.values()), 1
        while half < m:
            half *= 2
        for start in range(0, max(1, len(words)), half):
            both = sum((want & Counter(words[start:start + 2 * half])).values())
            if m and 100 * both >= percent * m:
                out.append((label, t, start, min(start + 2 * half, len(words)), both / m))
    return sorted(out, key=lambda x: (x[2], x[3], x[0], x[1]))


def test_licenses_query(spark, docs):
    got = {r.doc_id: r for r in queries.queries()["op11_licenses"](spark, SF_SMALL).collect()}
    assert got.keys() == {d for d, _ in docs}
    some = 0
    for doc_id, text in docs:
        words = license_words(text)
        places = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
        found = blocks_by_hand(text, licenses.TEMPLATES, licenses.PERCENT)
        base = {label for _, label in places}
        r = got[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), min(places, default=[None])[0], max(places, default=[None])[0])
        assert (r.base_labels, r.labels) == (",".join(sorted(base)), ",".join(sorted(base | {f[0] for f in found})))
        assert r.score == (1.0 if base else max((f[4] for f in found), default=0.0))
        some += bool(found)
    assert some


def test_licenses_blocks(spark):
    """Edited, scattered and repeated notices, blocks at every offset, and thresholds from half to all."""
    rng = random.Random(5)
    rows = []
    for i in range(150):
        words = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(3)):
            notice = license_words(rng.choice(licenses.TEMPLATES)[1])
            notice = [w if rng.random() > 0.08 else "other" for w in notice]
            if rng.random() < 0.3:
                rng.shuffle(notice)
            at = rng.randrange(len(words) + 1)
            words[at:at] = notice
        rows.append((i, " ".join(words)))
    rows += [(200, "the the the software " * 300), (201, "Copyright" * 3), (202, "")]
    templates = [*licenses.TEMPLATES, ("repeats", "the the the software the"), ("none", "!"), ("one", "sublicense")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (50, 80, 90, 100):
        got = {r.doc_id: [tuple(f) for f in r.found] for r in licenses.scan_licenses(df, templates, percent).collect()}
        assert got == {i: blocks_by_hand(t, templates, percent) for i, t in rows}


def test_base_phrases():
    words = licenses.words_of("CC BY cc-by 4.0 ccby cc cc by, ALL rights\nreserved General  Public license É cc")
    assert licenses.base_places(words) == [("cc-by", 0), ("cc-by", 2), ("cc-by", 8), ("reserved", 10), ("gpl", 13)]
    assert words[-2] == "É".encode()


# hard negatives

def mined_by_hand(rows):
    """rows: (id, label, integer vector)."""
    out = []
    width = max((len(v) for *_, v in rows), default=0)
    m = np.array([list(v) + [0] * (width - len(v)) for *_, v in rows], object).reshape(len(rows), width)
    key = [x if x is not None else 1 << 63 for x, *_ in rows]
    for a, (i, label, _) in enumerate(rows):
        if i is None or i % 100:
            continue
        score = [int(sum(x * y for x, y in zip(m[a], v, strict=True))) for v in m]
        order = sorted((b for b in range(len(rows)) if b != a), key=lambda b: (-score[b], key[b], b))
        for p in [b for b in order if rows[b][1] == label][:5]:
            fit = [b for b in order if rows[b][1] != label and 80 * score[p] <= 100 * score[b] <= 100 * score[p]][:5]
            out += [(i, rows[p][0], k, rows[b][0], score[p], score[b]) for k, b in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "id long, label long, vector array<long>")
    return sorted(map(tuple, hardneg.mine_hard_negatives(df, F.col("id") % 100 == 0).collect()), key=str)


def test_hard_negatives_query(spark):
    assert "op12_hard_negatives" in queries.oracle_sql()
    got = queries.queries()["op12_hard_negatives"](spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = con.execute(queries.oracle_sql()["op12_hard_negatives"]).fetchall()
    columns = [d[0] for d in con.description]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want) and want


def test_hard_negatives_clusters(spark, monkeypatch):
    """Tight groups, many equal vectors, ties and a deep tree: nothing is lost, and the ranges rule leaves out."""
    monkeypatch.setattr(hardneg, "LEAF_SAMPLE", 8)
    monkeypatch.setattr(hardneg, "CHUNK_ROWS", 16)
    monkeypatch.setattr(hardneg, "BLOCK", 4)
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 300, (12, 8))
    rows = [(int(i), int(rng.integers(3)), [int(x) for x in centres[rng.integers(12)] + rng.normal(0, 15, 8)]) for i in range(0, 4000, 5)]
    rows += [(10_000 + i, i % 2, [7, -3, 250, 9, 0, 0, 0, 1]) for i in range(300)]
    rows += [(20_000, 0, [7, -3, 250, 9]), (20_000, 0, [7, -3, 250, 9])]
    visited = []
    visits = hardneg.Tree.visits

    def counted(self, q, *a):
        for leaf, k in visits(self, q, *a):
            visited.append(len(k))
            yield leaf, k
    assert mined(spark, rows) == mined_by_hand(rows)
    form = hardneg.Format(8, 1e6)
    x = form.stack([v + [0] * (8 - len(v)) for *_, v in rows])
    tree = hardneg.Tree(x)
    leaves = tree.leaf(x)
    for leaf in np.unique(leaves):
        for number, child in tree.paths[leaf]:
            node = tree.nodes[number]
            d = np.sqrt(hardneg.squared(node.points, x[leaves == leaf]))
            node.low[:, child] = np.minimum(node.low[:, child], d.min(axis=1))
            node.high[:, child] = np.maximum(node.high[:, child], d.max(axis=1))
            norm = (x[leaves == leaf] ** 2).sum(axis=1)
            node.norm_low[child], node.norm_high[child] = min(node.norm_low[child], norm.min()), max(node.norm_high[child], norm.max())
    q = x[:200]
    own = (q @ x.T)
    low_, high = np.sort(own, axis=1)[:, -20], own.max(axis=1)
    seen = {(k, leaf) for leaf, rows_ in counted(tree, q, low_, high) for k in rows_}
    need = {(k, leaves[j]) for k in range(len(q)) for j in np.flatnonzero((own[k] >= low_[k]) & (own[k] <= high[k]))}
    assert need <= seen and len(seen) < 0.4 * len(q) * len(tree.paths)


@pytest.mark.parametrize("size", [10, 10 ** 5, 10 ** 8])
def test_hard_negatives_exact_at_any_size(spark, size):
    """Products beyond 2**24 and 2**53 stay exact; negative and zero scores."""
    rng = random.Random(size)
    rows = [(i * 25, rng.randrange(3), [rng.randrange(-size, size) for _ in range(4)]) for i in range(120)]
    assert mined(spark, rows) == mined_by_hand(rows)


def test_hard_negatives_edges(spark):
    from pyspark.sql import functions as F
    rows = [(0, 1, [3, 4]), (None, 1, [3, 4]), (None, 0, [3, 3]), (1, 1, [3]), (2, 0, [3, 4]), (2, 0, [3, 4]), (100, 0, []), (200, None, [1, 1]),
            (300, 1, None), (400, 1, [1, None])]
    kept = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]
    assert mined(spark, rows) == mined_by_hand(kept)
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1])]) == [] and mined(spark, [(0, 1, [1])]) == []
    clash = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "id long, label long, vector array<long>, row long, leaf long, score string")
    assert hardneg.mine_hard_negatives(clash, F.col("id") % 100 == 0).count() == len(mined_by_hand(kept))


def test_hard_negatives_unusable_components(spark, tmp_path):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [0.1 * (i % 5), 0.3], i % 2) for i in range(0, 300, 10)] + [(500, [inf, 0.1], 1), (600, [nan, 0.1], 1), (700, [None, 0.1], 1), (800, [-inf], 1), (900, None, 1), (1000, [0.1, 0.1], None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.queries()["op12_hard_negatives"](spark, str(tmp_path)).collect()
    quantised = [(i, (y + 1) % 10 if i % 7 == 0 else y, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, y in rows[:30]]
    assert sorted(map(tuple, got), key=str) == mined_by_hand(quantised)


# spelling variants

def variants_by_hand(docs):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += len(run) >= 6
    words = {w: n for w, n in total.items() if n >= 5}
    near = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            if (x := w[:i] + w[i + 1:]) in words:
                near[w].add(x)
                near[x].add(w)
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1:]), set()).add(w)
    for g in holes.values():
        for w in g:
            near[w] |= g - {w}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 5 * words[w]:
            form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(near[w]), words.get(form.get(w)))
    return out


def grouped(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_variants_query(spark, docs):
    want = variants_by_hand(docs)
    assert grouped(queries.queries()["op13_variants"](spark, SF_SMALL)) == want
    assert any(f for f, *_ in want.values())


def test_variants_dense(spark, monkeypatch):
    """Few letters, so that blocks are large and cut into chunks; chains of forms; long words."""
    monkeypatch.setattr(variants, "CHUNK_WORDS", 7)
    monkeypatch.setattr(variants, "PRODUCT", 50)
    rng = random.Random(1)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(6, 9))) for _ in range(400)]
    text = [w for k, w in enumerate(words) for _ in range(5 * 5 ** (k % 4))]
    chain = ["kkkkkk" + "z" * k for k in range(6)]
    text += [w for k, w in enumerate(chain) for _ in range(6 ** (6 - k))]
    long = ["x" * 3000, "x" * 2999 + "y", "y" + "x" * 3000, "ÿ" * 2100]
    text += long * 6
    rng.shuffle(text)
    rows = [(i, " ".join(text[i::40]).upper() if i % 2 else "1".join(text[i::40])) for i in range(40)]
    got = grouped(variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert got == variants_by_hand(rows)
    assert got[chain[5]][1] == chain[0]


def test_edits():
    rng = random.Random(2)
    for _ in range(400):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 7)))
        for b in ("".join(rng.choice("ab") for _ in range(len(a))), "".join(rng.choice("ab") for _ in range(len(a) + 1))):
            one = sum(x != y for x, y in zip(a, b)) == 1 if len(a) == len(b) else any(b[:i] + b[i + 1:] == a for i in range(len(b)))
            assert variants.edits(*(variants.matrix(x.encode(), len(x)) for x in (a, b))).tolist() == [one]


def test_edge_rows(edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert grouped(variants.spelling_variants(edge)) == variants_by_hand(rows)
    assert variants.spelling_variants(empty).collect() == []
    found = licenses.scan_licenses(edge)
    assert sorted(str((r.doc_id, r.n_words)) for r in found.collect()) == sorted(str((i, len(license_words(t)))) for i, t in rows)
    assert licenses.scan_licenses(empty).collect() == [] and licenses.scan_licenses(edge, []).where("size(found) > 0").count() == 0
