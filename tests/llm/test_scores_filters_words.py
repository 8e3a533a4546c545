"""Language-model scores, the filter audit and spelling variants against plain brute force; corpus queries over the smallest tables."""

import hashlib
import math
import os
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sheetforge.llm import bpe, exact_dedup, filter_audit, lm, registry, spelling, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n bigint, word string, part string, row int, first string, A boolean, mask int, gid int, score double"


def documents(spark, rows):
    """rows: (doc_id, text[, lang]); further columns clash with names that operators use."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", -1, "w", "p", -1, "f", True, 3, 4, 0.5) for r in rows], SCHEMA)


def words(rng, n, vocabulary=300):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \n"), (4, "a"), (4, "a"), (None, "b"), (None, None), (5, "A b C"), (6, "\U0001f600 é"), (7, "one $ two"), (8, "x" * 3_000_000), (9, "Straße été " * 40_000)]


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# --- 11 language-model scores


def plain_scores(rows, lex, model):
    """Every token by itself, from dictionaries of strings."""
    held = {d: zlib.crc32(str("" if d is None else d).encode()) % 5 == 1 for d, *_ in rows}
    count = Counter(w for d, t, *_ in rows if not held[d] for w in [*tokens(t), None])
    n, v = sum(count.values()), len(count)
    kind = lambda w: int(lm.endings(np.frombuffer(w.encode(), np.uint8), np.zeros(1, np.int64), lm.CLASSES)[0])
    key = lambda w: next(lm.tokens(pa.array([w])))[2][0]
    own = {}
    for w in {w for w in count if w is not None}:
        at = int(lex.find(np.array([key(w)]))[0])
        if at >= 0 and lex.head_out[at] >= 0:
            own[w] = int(lex.head_out[at])
    kinds_n, kinds_v = Counter(), Counter()
    for w, c in count.items():
        if w is not None and w not in own:
            kinds_n[kind(w)] += c
            kinds_v[kind(w)] += 1
    out = {}
    for d, t, *_ in rows:
        base = score = 0.0
        known, before = 0, [lm.START, lm.START]
        for w in [*tokens(t), None]:
            base += math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1)))
            known += count[w] > 0
            place = lm.END if w is None else own.get(w, None)
            if place is None:
                k = kind(w)
                place = 2 + lex.n_words + k
                score += math.log10((count[w] + 0.5) / (kinds_n[k] + 0.5 * (kinds_v[k] + 1)))
            scores = [float(model.one[before[0], j]) + float(model.two[before[1], j]) for j in range(1, len(model.one))]
            score += (scores[place - 1] - math.log(sum(math.exp(s) for s in scores))) / math.log(10)
            before = [before[1], place]
        out[(d, t)] = (held[d], len(tokens(t)) + 1, known, n, base, score)
    return out


@pytest.mark.parametrize("head", [40, lm.HEAD])
def test_scores_match_plain_sums(spark, head, monkeypatch):
    """Also where most words are outside the table that every worker has."""
    rng = random.Random(1)
    rows = [(10 + i, words(rng, rng.randrange(60), 150)) for i in range(60)] + [r for r in ODD if len(r[1] or "") < 100] + [(200, "Never seen Words, w3. w4")]
    kept = []
    monkeypatch.setattr(lm, "HEAD", head)
    monkeypatch.setattr(lm, "lexicon", lambda counted, n, f=lm.lexicon: kept.append(f(counted, n, 30, head=head)) or kept[-1])
    monkeypatch.setattr(lm, "fit", lambda docs, lex, f=lm.fit: kept.append(f(docs, lex, 2000)) or kept[-1])
    got = lm.score_documents(documents(spark, rows)).collect()
    lex, model = kept
    assert len(lex.head) <= head and lex.n_words == min(30, len(lex.head))
    want = plain_scores(rows, lex, model)
    assert len(got) == len(rows)
    left = Counter((d, t) for d, t, *_ in rows)
    by_id = defaultdict(list)
    for d, t in left.elements():
        by_id[d].append(want[(d, t)])
    for r in got:
        mine = (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
        hit = next(w for w in by_id[r["doc_id"]] if w[:4] == mine[:4] and abs(w[4] - mine[4]) < 1e-6 and abs(w[5] - mine[5]) < 1e-4)
        by_id[r["doc_id"]].remove(hit)


def test_scores_of_odd_rows(spark):
    rows = ODD
    got = {r["doc_id"]: r for r in lm.score_documents(documents(spark, rows)).collect()}
    assert got[8]["n_tokens"] == 2 and got[9]["n_tokens"] == 80_001 and got[1]["n_tokens"] == got[2]["n_tokens"] == got[3]["n_tokens"] == 1
    assert got[1]["score"] == pytest.approx(got[2]["score"]) and all(r["score"] < 0 and math.isfinite(r["score"]) for r in got.values())
    assert lm.score_documents(documents(spark, [])).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    alone = lm.score_documents(documents(spark, [(held, "a b")])).first()
    assert alone["train_tokens"] == alone["n_known"] == 0 and alone["base_score"] == 0 and math.isfinite(alone["score"])


def test_model_is_normalised_and_beats_counts(spark):
    """Two invented languages: the two tokens before tell which, so held-out texts are likelier than by counts alone."""
    rng = random.Random(2)
    rows = [(i, " ".join(f"{'pq'[i % 2]}{int(rng.expovariate(0.05))}{rng.choice('xy')}" for _ in range(60))) for i in range(300)]
    got = [r for r in lm.score_documents(documents(spark, rows)).collect() if r["held_out"]]
    assert len(got) > 30 and sum(r["score"] for r in got) > sum(r["base_score"] for r in got) + 0.1 * sum(r["n_tokens"] for r in got)
    network = lm.Network(np.array([0, 5, 9, 2, 0, 7]), 4)
    network.train(np.array([[0, 0, 2], [0, 2, 3], [2, 3, 1]] * 50), 2, 16, 8)
    model = network.model()
    for a in range(6):
        p = np.exp(model.log_probabilities(np.full(5, a), np.full(5, 3), np.arange(1, 6)))
        assert p.sum() == pytest.approx(1) and (p > 0).all()


def test_gradients():
    rng = np.random.default_rng(3)
    network = lm.Network(np.array([0, 5, 9, 2, 4]), 3)
    network.weights["Q"] = rng.normal(size=(5, 3))
    context, target, noise = rng.integers(0, 5, (7, 2)), rng.integers(1, 5, 7), rng.integers(1, 5, 6)
    grads = network.gradients(context, target, noise)
    for name, value in network.weights.items():
        for at in [tuple(rng.integers(0, n) for n in value.shape) for _ in range(6)]:
            old, eps = value[at], 1e-6
            value[at] = old + eps
            up = network.loss(context, target, noise)
            value[at] = old - eps
            down = network.loss(context, target, noise)
            value[at] = old
            assert grads[name][at] == pytest.approx((up - down) / (2 * eps), abs=1e-6)


def test_weights_are_fitted_to_all_places(spark):
    """Each place of the training text counts once, and the gradients are those of the likelihood of the whole text."""
    rng = random.Random(5)
    rows = [(i, words(rng, rng.randrange(30), 12)) for i in range(40)] + [(99, None)]
    docs = documents(spark, rows)
    lex = lm.lexicon(lm.counts(docs, 3), len(rows), 6, 3)
    one, two = lm.followers(docs, lex, 3)
    contexts = lm.contexts_of(two)
    assert one.sum() == two.sum() == contexts.sum() == lex.n_tokens and (two.sum(0) == lex.totals()).all() and (one.sum(1) == contexts.sum(1)).all() and (two.sum(1) == contexts.sum(0)).all()
    network = lm.Network(lex.totals(), 3)
    network.weights["Q"] = np.random.default_rng(6).normal(size=network.weights["Q"].shape)
    grads = network.likelihood(one, two, contexts)[1]
    model, mean = network.model(), 0.0
    for place in np.ndindex(contexts.shape):
        mean += contexts[place] * np.log(np.exp(model.log_probabilities(*[np.full(len(one) - 1, x) for x in place], np.arange(1, len(one)))).sum())
    assert abs(mean) < 1e-2
    for name, value in network.weights.items():
        at, eps = tuple(n - 1 for n in value.shape), 1e-5
        value[at] += eps
        up = network.likelihood(one, two, contexts)[0]
        value[at] -= 2 * eps
        down = network.likelihood(one, two, contexts)[0]
        value[at] += eps
        assert grads[name][at] == pytest.approx((up - down) / (2 * eps), abs=1e-6)
    before = network.likelihood(one, two, contexts)[0]
    network.learn(one, two, contexts)
    assert network.likelihood(one, two, contexts)[0] < before


def test_followers_come_as_columns(spark):
    rng = np.random.default_rng(8)
    docs = documents(spark, [(i, " ".join(f"w{x}" for x in rng.integers(0, 400, 500))) for i in range(300)])
    lex = lm.lexicon(lm.counts(docs), 300)
    lm.followers(docs, lex)
    tracemalloc.start()
    try:
        one, two = lm.followers(docs, lex)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    cells = int((one > 0).sum() + (two > 0).sum())
    assert cells > 150_000 and most < one.nbytes + two.nbytes + 40 * cells  # a row object a cell took more than 100 bytes


def test_lm_query(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, words(rng, 40)) for i in range(100)] + [(500 + i, words(random.Random(5), 50)) for i in range(50)] + [(900, None)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = lm.op11_lm(spark, str(tmp_path))
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert [t for _, t in out.dtypes] == ["bigint", "boolean", "bigint", "bigint", "bigint", "double", "double"]
    got = {r["doc_id"]: r for r in out.collect()}
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 1]
    count = Counter(w for _, t in train for w in [*tokens(t), None])
    n, v = sum(count.values()), len(count)
    for d, t in rows:
        assert got[d]["train_tokens"] == n and got[d]["n_known"] == sum(count[w] > 0 for w in [*tokens(t), None])
        assert got[d]["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*tokens(t), None]))


# --- 12 filter audit


def plain_audit(rows, labels):
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    parts = defaultdict(list)
    for d, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > first[t]}
        parts[lang or ""].append(({f for f in fails if fails[f]}, *labels.get(d, (0, 0))))
    out = []
    for part, docs in parts.items():
        shapley, mine = Counter(), []
        for order in permutations("ABCDE"):
            left, before = docs, []
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                early = sum(f in x[0] for x in before)
                before = before + gone
                mine.append((f, (part, "".join(order), step, len(left), len(gone), early, sum(x[0] == {f} for x in docs), sum(x[1] for x in gone), sum(x[2] for x in gone))))
        out += [(*m, shapley[f]) for f, m in mine]
    return Counter(out)


def audit_rows(rng):
    out = [(*r[:2], rng.choice(["en", "de", None, ""])) for r in ODD]
    for i in range(150):
        text = " ".join(rng.choice(["Word", "word", "AAA", "x#", "b"]) + str(rng.randrange(rng.choice([20, 400]))) for _ in range(rng.randrange(60, 160)))
        out.append((100 + i, text, rng.choice(["en", "de", "fr"])))
    out += [(1000 + i, out[20][1], rng.choice(["en", "fr"])) for i in range(120)]  # a hot group over two parts
    return out


def test_filter_audit(spark):
    rng = random.Random(6)
    rows = audit_rows(rng)
    marks = [(d, rng.randrange(2), rng.randrange(2)) for d in {d for d, *_ in rows if d is not None} if rng.random() < 0.6]
    labels = spark.createDataFrame([*marks, *[(d, 0, 0) for d, *_ in marks[:20]], (None, 1, 1), (10**9, 1, 1)], "doc_id long, quality int, toxic int")
    out = filter_audit.audit_documents(documents(spark, rows), labels)
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    known = {d: (q, t) for d, q, t in marks}
    got = out.where("not whole").select(*names).collect()
    assert Counter(tuple(r) for r in got) == plain_audit(rows, known)
    assert len(got) == 600 * len({r[2] or "" for r in rows})
    whole = Counter(tuple(r) for r in out.where("whole").select(*names).collect())
    assert whole == plain_audit([(d, t, "") for d, t, _ in rows], known)
    empty = documents(spark, [])
    assert filter_audit.audit_documents(empty, labels).where("not whole").count() == 0
    assert filter_audit.audit_documents(documents(spark, rows[:5]), labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_audit_of_other_filters(spark):
    """Three flags, nulls among them, and no measure."""
    rows = spark.createDataFrame([("a", True, None, False), ("a", False, False, False), ("a", True, True, False), ("b", None, None, None)], "part string, x boolean, y boolean, z boolean")
    got = {(r["part"], r["filter_order"], r["step"]): r for r in filter_audit.audit(rows, ("x", "y", "z"), ()).where("not whole").collect()}
    assert len(got) == 2 * 6 * 3
    r = got["a", "yxz", 2]
    assert (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) == (1, 1, 1, 1, 3 * 2 + 3 * 1)
    assert got["b", "xyz", 3]["kept"] == 1


def check_query(spark, tmp_path, query, sql, tables):
    """The query over written tables against its SQL."""
    con = duckdb.connect()
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    out = query(spark, str(tmp_path))
    want = con.execute(sql)
    names = [x[0] for x in want.description]
    assert sorted(out.columns) == sorted(names)
    assert Counter(tuple(r) for r in out.select(*names).collect()) == Counter(want.fetchall())


def test_audit_query(spark, tmp_path):
    rng = random.Random(7)
    labels = spark.createDataFrame([(100 + i, i % 2, i % 3 == 0) for i in range(90)], "doc_id long, quality int, toxic boolean").withColumn("toxic", F.col("toxic").cast("int"))
    check_query(spark, tmp_path, filter_audit.op12_filter_audit, filter_audit.ORACLE, {"documents": documents(spark, audit_rows(rng)), "labels": labels})


# --- 13 spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(count, ratio=5):
    form, near = {}, {}
    for w, n in count.items():
        close = [x for x in count if one_edit(w, x)]
        near[w] = len(close)
        best = min(close, key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= ratio * n else None
    out = set()
    for w, n in count.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, near[w], None if form[w] is None else count[form[w]]))
    return out


def invented(rng, n, letters="abé"):
    out = {}
    while len(out) < n:
        out["".join(rng.choice(letters) for _ in range(rng.randrange(1, 7)))] = rng.choice([1, 2, 5, 10, 30, 200, 1000, 5000])
    return out


@pytest.mark.parametrize("kind", ["one slice", "slices", "few bits", "far letters"])
def test_variants(spark, kind, monkeypatch):
    """Small alphabets make dense neighbourhoods; a full filter and several slices change nothing."""
    if kind == "slices":
        monkeypatch.setattr(spelling, "SLICE", 60)
    if kind == "few bits":
        monkeypatch.setattr(spelling, "MOST_BITS", 1 << 12)
    count = invented(random.Random(8), 220, "a中\U0001f600e" if kind == "far letters" else "abé")
    table = spark.createDataFrame(list(count.items()), "word string, n long")
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling.variants(table).collect()]
    assert len(got) == len(count) and set(got) == plain_variants(count)


def test_neighbourhoods_are_whole_and_distinct():
    alphabet = np.array(sorted(map(ord, "abc")), np.uint32)
    for word in ("a", "aab", "abcabc", "ccccc"):
        found = []
        points = np.array([[ord(c) for c in word]], np.uint32)
        with np.errstate(over="ignore"):
            for _, m in spelling.neighbours(points, alphabet, lambda h: np.ones(len(h), bool)):
                found += ["".join(map(chr, r)) for r in m.tolist()]
        want = {word[:i] + word[i + 1 :] for i in range(len(word))} | {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in "abc"} | {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in "abc"}
        assert len(found) == len(set(found)) and set(found) == want - {word}


def test_shifted_hashes_are_the_strings_own():
    seen = []

    def holds(h):
        seen.append(h)
        return np.ones(len(h), bool)

    with np.errstate(over="ignore"):
        points = np.array([[ord(c) for c in "spelling"]], np.uint32)
        got = np.concatenate([spelling.hashes(m) for _, m in spelling.neighbours(points, np.array([101, 233], np.uint32), holds)])
    assert set(got.tolist()) <= set(np.concatenate(seen).tolist())


def typed(rows, least=6, typo=199):
    count = Counter()
    for d, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % typo == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                count[run] += 1
    return count


def spelling_rows(rng):
    stems = ["ElÈment", "spelling", "straße", "colour", "color", "window", "aaaaaaa", "aaaaaa", "naïveté", "short", "fiveee"]
    out = [(i, " ".join(rng.choice(stems) + rng.choice(["", "", "s", "-x", "¡"]) for _ in range(40))) for i in range(200)]
    return out + [(d, t) for d, t in ODD] + [(300, "WindowĀwindow 中colour×colour")] * 3


def test_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    monkeypatch.setattr(spelling, "LONG", 1000)
    rows = spelling_rows(random.Random(9))
    got = {r["word"]: r["n"] for r in spelling.vocabulary(documents(spark, rows), typo=7).collect()}
    assert got == {w: n for w, n in typed(rows, typo=7).items() if n >= 5}
    assert spelling.variants(spelling.vocabulary(documents(spark, []))).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([("a", 1)], "word string, n long"), 1)


def test_spelling_query(spark, tmp_path):
    rows = [r for r in spelling_rows(random.Random(10)) if len(r[1] or "") < 10**6]
    check_query(spark, tmp_path, spelling.op13_spelling, spelling.ORACLE, {"documents": documents(spark, rows)})
    got = {r["word"]: r for r in spelling.op13_spelling(spark, str(tmp_path)).collect()}
    count = {w: n for w, n in typed(rows).items() if n >= 5}
    assert {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got.values()} == plain_variants(count)


FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't here")


@given
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_given_tables(spark, name):
    """Every corpus query that SQL can express, over the smallest tables."""
    con = duckdb.connect()
    for t in ("documents", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    want = con.execute(registry.ORACLE_SQL[name])
    names = [x[0] for x in want.description]
    plain = lambda rows: Counter(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)
    out = registry.QUERIES[name](spark, FOLDER)
    assert plain(tuple(r) for r in out.select(*names).collect()) == plain(want.fetchall()) != Counter()


@given
def test_token_queries(spark):
    """op4 and op9 against the libraries, text by text."""
    import public_tokenizers
    import tokenizers

    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    words = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, {}
    for d, t in docs:
        ids = [*words.encode(t or "", add_special_tokens=False).ids, 1]
        want[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in registry.QUERIES["op4_token_store"](spark, FOLDER).collect()} == want
    enc = bpe.encoding(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
    ids = {d: np.array(enc.encode_ordinary(t or ""), "<u4").tobytes() for d, t in docs}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in registry.QUERIES["op9_bpe"](spark, FOLDER).collect()}
    assert got == {d: (len(ids[d]) // 4, hashlib.sha256(ids[d]).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in docs}


# --- mended


def test_repeated_rows_of_exact_duplicates(spark):
    """Columns of any names stay, and of rows that repeat doc_id and text the same one stays in every order of rows."""
    rows = [(1, "t", "b", 2), (1, "t", "a", 9), (1, "t", "a", 3), (2, "u", "z", 1), (None, "v", "q", 1), (None, "v", "p", 1)]
    schema = "doc_id long, text string, _sha string, rep int"
    want = [(1, "t", "a", 3), (2, "u", "z", 1), (None, "v", "p", 1)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, schema).withColumnsRenamed({"rep": "_uid"}).withColumn("text_sha256", F.lit("x")).withColumn("a.b", F.lit(1))
        out = exact_dedup.drop_exact_duplicates(docs)
        assert out.columns == docs.columns
        assert sorted((tuple(r)[:4] for r in out.collect()), key=str) == sorted(want, key=str)


def test_toxicity_learns_from_a_bounded_sample(spark, monkeypatch):
    """One labelled doc_id on thousands of rows is one text; bytes are bounded too."""
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, y, prior: seen.append((len(texts), sum(map(len, texts)), sorted(set(y.tolist())))))
    some = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(some[0], f"text {i}") for i in range(5000)] + [(i, "word " * 50) for i in some[1:]]
    labels = spark.createDataFrame([(i, i % 2) for i in some] + [(some[0], 1)] * 3000 + [(None, 1), (some[1], None)], "doc_id long, toxic int")
    docs = documents(spark, rows)
    toxicity.learn(docs, labels, 1000)
    assert seen[-1][0] == len(some) and seen[-1][2] == [0, 1]
    monkeypatch.setattr(toxicity, "MOST_BYTES", 4000)
    toxicity.learn(docs, labels, 1000)
    assert 0 < seen[-1][1] < 8000
