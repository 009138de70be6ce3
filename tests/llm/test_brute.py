"""The queries against brute force on the smallest tables, and the methods' own laws."""
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from hrlens.llm import dac, decontaminate, fingerprints, lm, mixing, neardup, pii, queries, secrets, toxicity
from tests.conftest import SF_SMALL

tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def result(spark, name):
    return {r.doc_id: r for r in queries.queries()[name](spark, SF_SMALL).collect()}


def held(i, mod):
    return zlib.crc32(str(i).encode()) % mod == 2


def test_toxicity(spark, docs):
    got = result(spark, "op1_toxicity")
    assert got.keys() == docs.keys()
    assert all(r.held_out == held(i, 4) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for i, r in got.items())
    pos = ["nice day you vile worm " + f"t{i}" for i in range(60)]
    unl = [f"nice day to walk u{i}" for i in range(270)] + [f"what a vile worm w{i}" for i in range(30)]
    model = toxicity.train(pos, unl, 0.1)
    assert model.score("a vile worm again") > 0.5 > 0.3 > model.score("nice walk today")
    assert model.score("") < 0.3


def test_nnpu_ignores_hidden_positives():
    """A feature of positives only scores high although unlabelled rows with it count as clean at first."""
    rows = np.arange(140)
    cols = np.array([0] * 40 + [0] * 10 + [1] * 90)
    w, b = toxicity.nnpu_fit(rows, cols, 140, 2, np.arange(140) < 40, 0.1)
    assert w[0] + b > 0 > w[1] + b


def test_sharding(spark, docs):
    got = result(spark, "op3_sharding")
    size = {i: len(t.encode()) + 8 for i, t in docs.items()}
    total, before = sum(size.values()), 0
    slots = Counter()
    for i in sorted(docs):
        shard = (2 * before + size[i]) * 24 // (2 * total)
        before += size[i]
        assert (got[i].size, got[i].shard, got[i].slot, got[i].text_crc32) == (size[i], shard, slots[shard], zlib.crc32(docs[i].encode()))
        slots[shard] += 1


def test_fingerprints(spark, docs):
    got, ids = result(spark, "op4_fingerprints"), sorted(docs)
    for i, j in zip(ids, ids[1:] + ids[:1], strict=True):
        changed = fingerprints.edited(docs[i], docs[j])
        own, other, following = (fingerprints.fingerprint_texts([t])[0] for t in (docs[i], changed, docs[j]))
        r = got[i]
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (len(docs[i]), own, other)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (r.near_edited, r.near_next) == (fingerprints.likeness(own, other), fingerprints.likeness(own, following))


def test_interior_phrases_do_not_depend_on_offset(docs):
    text = max(docs.values(), key=len)[:4000]
    sets = []
    for before in ("", "x", "another start "):
        _, _, phrase = fingerprints.parse([fingerprints.code_points(before + text)])
        sets.append(set(phrase.tolist()))
    assert len(sets[0] & sets[1] & sets[2]) > 0.9 * len(sets[0])


def test_language_model(spark, docs):
    got = result(spark, "op5_language_model")
    count = Counter(w for i, t in docs.items() if not held(i, 7) for w in [*lm.tokens(t), lm.END])
    n, v = sum(count.values()), len(count)
    for i, t in docs.items():
        words = [*lm.tokens(t), lm.END]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i, 7), len(words), sum(count[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    kept = [r for i, r in got.items() if not held(i, 7)]
    assert sum(r.score for r in kept) > sum(r.base_score for r in kept)


def test_filter_levels():
    """A count's level is never underestimated, and rarely overestimated."""
    rng = np.random.default_rng(0)
    h, c = rng.integers(0, 2**63, 20_000).astype(np.uint64), rng.integers(1, 300, 20_000)
    part = lm.build_part(h, c)
    s = lm.Slice(0, np.frombuffer(part, np.uint8), np.array([0]), np.array([len(part) * 8], np.uint64))
    found, level = s.levels(h, np.zeros(len(h), int)), np.floor(np.log2(c))
    assert (found >= level).all() and (found == level).mean() > 0.98
    unseen = s.levels(rng.integers(0, 2**63, 20_000).astype(np.uint64), np.zeros(20_000, int))
    assert (unseen >= 0).mean() < 0.02


def brute_groups(texts, n):
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = frozenset(zip(*[w[k:] for k in range(n)], strict=False)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[:a]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(spark, docs):
    got = result(spark, "op7_minhash")
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute_groups(docs, 2)
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_near_copies_of_one_text(spark):
    """A family of edited copies, many of them apart from one another, and a chain."""
    rng = np.random.default_rng(1)
    base, texts = [f"w{k}" for k in range(120)], {}
    for i in range(60):
        words = list(base)
        for p in rng.choice(120, i % 9, replace=False):
            words[p] = f"e{i}x{p}"
        texts[i] = " ".join(words)
    for i in range(60, 70):
        texts[i] = " ".join(f"c{k}" for k in range(8 * (i - 60), 8 * (i - 60) + 150))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame, 2).collect()}
    assert got == brute_groups(texts, 2)


def test_permutations_of_minhash():
    x = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(neardup.sigma(x))) == len(np.unique(neardup.pi(x.copy()))) == 1 << 16


def test_decontamination(spark, docs):
    found = queries.op6_decontamination(spark, SF_SMALL).collect()
    items = {r.item_id: b" ".join(decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    exact = {(i, k) for i, t in docs.items() for k, item in items.items() if b" " + item + b" " in b" " + b" ".join(decontaminate.words_of(t)) + b" "}
    assert exact and exact <= {(r.doc_id, r.item_id) for r in found}


def test_edited_copy(spark):
    item = [f"w{k}" for k in range(40)]
    copy = ["new" if k % 6 == 5 else w for k, w in enumerate(item)]
    docs = spark.createDataFrame([(1, "start " * 50 + " ".join(copy).upper() + ", end" * 9), (2, " ".join(item[:6]) + " z" * 40)], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    r = decontaminate.contaminated(docs, items).collect()
    assert [(x.doc_id, x.item_id, x.first_word) for x in r] == [(1, 7, 50)] and 0.5 <= r[0].score < 1


def test_edited_copies_that_are_frequent(spark):
    item = [f"w{k}" for k in range(22)]
    copy = ["new" if k in (3, 8, 13, 18) else w for k, w in enumerate(item)]
    docs = spark.createDataFrame([(0, " ".join(item)), *((i, f"d{i} " + " ".join(copy)) for i in range(1, 9))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in decontaminate.contaminated(docs, items).collect()}
    assert got == pytest.approx({0: 1.0} | dict.fromkeys(range(1, 9), 32 / 44))


def test_gate_against_ungated_alignment():
    """Every text whose whole-text alignment reaches the threshold is found, with the same score, and no other."""
    rng, over = random.Random(1), 0
    for k in range(1500):
        size, n = rng.randint(3, 40), rng.choice((8, 40, 1000))
        item = [f"v{rng.randrange(n)}" for _ in range(size)]
        copy, every = [], rng.choice((1, 2, 3, 4, 5, 6))
        for i, w in enumerate(item):
            edit = rng.choice("dica") if i % every == k % every else ""
            copy += {"d": [], "i": [w, "new"], "c": ["new"], "a": [f"v{rng.randrange(n)}"]}.get(edit, [w])
        text = [f"v{rng.randrange(n)}" for _ in range(rng.randint(0, 60))] + copy + [f"v{rng.randrange(n)}" for _ in range(rng.randint(0, 60))]
        seeds = decontaminate.Seeds([7], [" ".join(item)])
        flat = np.array([seeds.vocabulary.get(w.encode(), -1) for w in text], np.int64)
        score = decontaminate.align(seeds.items[0], flat)[0] / (2 * size)
        got = [x[4] for x in seeds.matches([" ".join(text)])]
        assert got == ([pytest.approx(score)] if score >= decontaminate.THRESHOLD else [])
        over += bool(got)
    assert 500 < over < 1500


@pytest.mark.parametrize("item,changed,score", [
    ([f"w{k}" for k in range(15)], (2, 5, 8, 11), 18 / 30), ([f"w{k}" for k in range(30)], range(2, 27, 3), 33 / 60), (["again"] * 15, (), 1.0)])
def test_copies_with_few_intact_words(spark, item, changed, score):
    text = " ".join("new" if k in changed else w for k, w in enumerate(item))
    r = decontaminate.contaminated(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert [x.score for x in r] == [pytest.approx(score)]


def test_mixing():
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice([f"{d}{k}" for k in range(40)], 30)) for d in "ab" for _ in range(60)]
    model = mixing.train(texts, ["a"] * 60 + ["b"] * 60)
    p, n = model.posterior(texts, mixing.WordIds())
    assert (p.argmax(axis=1) == np.repeat([0, 1], 60)).mean() > 0.95


def test_mixing_reaches_targets(spark):
    out, model = mixing.mixing_rates(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    rows = out.collect()
    p, t, r = np.array([x.posterior for x in rows]), np.array([x.n_tokens for x in rows]), np.array([x.rate for x in rows])
    want = np.array([mixing.TARGETS.get(d, 0.0) for d in model.domains])
    assert (r >= 0).all() and np.abs((r * t) @ p / t.sum() - want / want.sum()).max() < 2e-3
    assert all(abs(x.copies - x.rate) < 1 for x in rows)


def test_surrogates(spark, docs):
    text = "Ms Smith (jane@mail.example.com, +1 (366) 555-9807) met Jane Smith. Card 4111 1111 1111 1111, IBAN DE89370400440532013000, 10.0.0.1"
    frame = spark.createDataFrame([(1, text), (2, "no data here"), (3, None), (4, "Mr Jones, jane@mail.example.com")], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replace_personal_data(frame).collect()}
    new = got[1].text
    assert got[2].text == "no data here" and got[3].text is None
    for old in ("Smith", "jane@", "555-9807", "4111 1111", "DE8937", "10.0.0.1"):
        assert old not in new
    surname = re.search(r"Ms (\w+) ", new)[1]
    assert re.search(rf"met ({'|'.join(pii.GIVEN['latin', 'f'])}) {surname}\.", new) and surname not in got[4].text
    mail = re.search(r"[\w.]+@[\w.]+", new)[0]
    assert mail in got[4].text and mail.endswith(".com")
    assert sorted(k for *_, k, _ in pii.detect(new)) == sorted(k for *_, k, _ in pii.detect(text))  # check digits hold


def test_mentions_of_names_found(spark):
    text = "Jane Smith wrote. Later Smith and Jane left; SMITH's car, jane too. JANE SMITH signed. Smithson stays."
    new = pii.replace_personal_data(spark.createDataFrame([(1, text), (2, "Smith and Jane without a full name")], "doc_id long, text string")).collect()
    new = {r.doc_id: r for r in new}
    words = re.findall(r"\w+", new[1].text)
    given, surname = words[:2]
    assert not {"jane", "smith"} & {w.lower() for w in words} and new[1].n_entities == 8
    assert [words[i] for i in (4, 6, 8, 11, 13, 14)] == [surname, given, surname.upper(), given.lower(), given.upper(), surname.upper()]
    assert new[1].text.endswith("Smithson stays.") and new[2].n_entities == 0


@pytest.mark.parametrize("mention,kind", [
    ("DE89 3704 0044 0532 0130 00", "IBAN"), ("GB29 NWBK 6016 1331 9268 19", "IBAN"), ("+49 30 901820", "PHONE"), ("+442079460018", "PHONE"),
    ("+33 (0)1 23 45 67 89", "PHONE"), ("2125550187", "PHONE"), ("2001:db8::8a2e:370:7334", "IP"), ("fe80:0:0:0:202:b3ff:fe1e:8329", "IP")])
def test_formats_of_numbers(mention, kind):
    [(start, end, found, norm)] = pii.detect(f"at {mention} ABCD or so")
    assert (start, end, found) == (3, 3 + len(mention), kind)
    new = pii.render(kind, mention, pii.surrogate(kind, norm))
    assert new != mention and [k for *_, k, _ in pii.detect(f"at {new} ABCD or so")] == [kind]
    if kind != "IP":
        assert re.sub("[0-9A-Z]", "0", new) == re.sub("[0-9A-Z]", "0", mention) and (new[:2] == mention[:2] or mention[0] == "2")


def test_numbers_that_are_none():
    for text in ("DE88 3704 0044 0532 0130 00", "at 12:34:56", "a::b", "std::vector", "1712345678 seconds", "+12 x", "12345678901234567890123"):
        assert pii.detect(text) == []


def test_surrogates_stay_distinct(spark):
    names = [a + b for a in "bcdfg" for b in "aeiou"]
    table = spark.createDataFrame([("SURNAME", n) for n in names], "type string, norm string")
    out = pii.surrogate_table(table, pii.Scratch(spark, "t")).collect()
    assert len({r.surrogate for r in out}) == len(names) and not {r.surrogate for r in out} & set(names)
    assert sorted(pii.permute(1000, i, b"k", "t") for i in range(1000)) == list(range(1000))


def brute_secrets(t):
    spans = [(m.start(), 0, "assign", m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 12]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(spans)


def test_secrets(spark, docs):
    got = result(spark, "op9_secrets")
    for i, t in docs.items():
        spans = brute_secrets(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in spans).encode()).hexdigest()
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == x for _, _, k, _ in spans) for x in secrets.BASE]


def test_lexer():
    text = 'base = "Xy7kQ29z"\nclient_secret = base + "Lm41pTq8"\ncolor = "Xy7kQ29zLm41"\npassword: "changeme123"\n"apiKey": "a1B2c3D4e5F6"'
    found = {(text[s:e], n) for k, s, e, n, _ in secrets.scan_text(text) if k == "literal"}
    assert found == {("Xy7kQ29z", "client_secret"), ("Lm41pTq8", "client_secret"), ("a1B2c3D4e5F6", "apiKey")}
    tricky = "password: token: abcdefghijklmn AKIAAKIA TOKEN='x=y_z.abcdefgh"
    assert [(s, k, e) for s, _, k, e in brute_secrets(tricky)] == [(s, k, e) for k, s, e, *_ in secrets.scan_text(tricky) if k in secrets.BASE]


@pytest.mark.parametrize("text", [
    'config["password"] = "LIT"', "$c['db']['password'] = 'LIT';", 'password: str = "LIT"', 'const apiKey: string = "LIT"', 'token: Optional[str] = "LIT"',
    'password = b"LIT"', "password = rb'LIT'", 'password = """LIT"""', "password = \'\'\'LIT\'\'\'", 'password = ("LIT")', 'password = (\n  "LIT"\n)',
    'password = os.getenv("P", "LIT")', 'x = f(g(1), "LIT")\npassword = x', "<password>LIT</password>", '<db><password type="a">\n LIT\n</password></db>'])
def test_lexer_forms(text):
    lit = "Xy7kQ29zLm41pT"
    text = text.replace("LIT", lit)
    assert lit in {text[s:e] for k, s, e, *_ in secrets.scan_text(text) if k == "literal"}
    assert {text[s:e] for k, s, e, *_ in secrets.scan_text(text) if k == "literal"} == {lit}


def test_lexer_shares_what_is_added_up():
    """Memory and time follow the text, not the number of times that names are added up."""
    double = 'x = "Xy7kQ29z"\n' + "x = x + x\n" * 40 + "password = x"
    assert [(double[s:e], n) for k, s, e, n, _ in secrets.scan_text(double) if k == "literal"] == [("Xy7kQ29z", "password")]
    lines = "".join(f's = s + "a{i}"\n' for i in range(4000)) + "token = s"
    tracemalloc.start()
    found = [f for f in secrets.scan_text(lines) if f[0] == "literal"]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 4001 and peak < 100 * len(lines)


def test_token_files(spark, docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    got, start = result(spark, "op10_dac"), 0
    for i in sorted(docs):
        ids = np.array([*t.encode(docs[i], add_special_tokens=False).ids, 0], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


ODD = ["", " ", "  a  b ", "a\n b\t c  \n d", "don't it's  we'll, 12 34,5  ..", "<|endoftext|> a <|endoftext|>b", "\x1c a \x85b \xa0c", " lead",
       "trail ", "\n", "a\n", "²½ x². 中文, \U0001f389!", "a​ b)", "word. word, word' word's 　x"]


def test_word_encoder_equals_whole_texts(docs):
    e = dac.WordEncoder(tokenizers.path("byte_bpe_50k.json"), limit=300)
    texts = ODD + list(docs.values())[:60] + ODD
    for k in range(0, len(texts), 20):
        want = e.tokenizer.encode_batch(texts[k:k + 20], add_special_tokens=False)
        assert [x.tolist() for x in e.encode(texts[k:k + 20])] == [w.ids for w in want]


def test_word_encoder_on_random_texts():
    rng = random.Random(3)
    parts = [*"ab Z9.\n\n  \t\r'$&#%*\"]}>|<_é　中\U0001f389\x1c\x85²s", "<|endoftext|>", " the", "n't", "'ll", " \n", "word"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(5000)]
    e = dac.WordEncoder(tokenizers.path("byte_bpe_50k.json"), limit=500)
    for k in range(0, len(texts), 250):
        want = e.tokenizer.encode_batch(texts[k:k + 250], add_special_tokens=False)
        assert [x.tolist() for x in e.encode(texts[k:k + 250])] == [w.ids for w in want]


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 2**32 - 1], list(range(0, 90_000, 7))])
def test_dac_round_trip(values):
    r = dac.DacReader(dac.dac_encode(np.array(values, np.uint32)))
    assert r.all().tolist() == values and [r[i] for i in range(0, len(values), 13)] == values[::13]
