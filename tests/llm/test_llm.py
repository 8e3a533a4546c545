"""The corpus operators against brute force, round trips and held-out rows, with nulls, empty texts, ties and empty tables."""

import hashlib
import random
import struct
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sheetforge.llm import _bytes, bpe, components, exact_dedup, langid, mixing, near_dedup, sharding, tiff, token_store, toxicity, warc
from sheetforge.llm._common import work_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score string, slot int, keep_id string, idx int"


def documents(spark, rows):
    """rows: (doc_id, text[, lang, source]); further columns clash with names that operators use."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), -1, "x", -1, "y", -1) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(rng, n, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \n"), (4, "a"), (4, "a"), (None, "b"), (None, None), (5, "a b c"), (6, "\U0001f600 é")]


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


# --- 1 sharding


def test_sharding_balances_and_keeps_order(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randrange(400)) for i in range(2000)] + ODD
    out = sharding.balanced_shards(documents(spark, rows), 24).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r)
    sizes = [sum(r["size"] for r in v) for v in by.values()]
    assert len(by) == 24 and max(sizes) - min(sizes) <= 2 * 408
    order = []
    for s in sorted(by):
        v = sorted(by[s], key=lambda r: r["slot"])
        assert [r["slot"] for r in v] == list(range(len(v)))
        order += [-1 if r["doc_id"] is None else r["doc_id"] for r in v]
    assert order == sorted(order)
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    assert sharding.balanced_shards(documents(spark, [])).count() == 0
    assert sharding.balanced_shards(documents(spark, rows[:3])).count() == 3


# --- 2 exact dedup


def brute_exact(rows):
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(t or "", []).append(d)
    best = {t: max(v, key=lambda x: (x is not None, x or 0)) for t, v in groups.items()}
    return Counter((d, best[t or ""], len(groups[t or ""]), sha(t)) for d, t, *_ in rows), len(groups)


@pytest.mark.parametrize("huge", [exact_dedup.HUGE, 1000])
@pytest.mark.parametrize("fields", [exact_dedup.FIELDS, ((3, 2), (5, 2))])
def test_exact_duplicates(spark, huge, fields):
    """Tiny moduli make different texts collide; the comparison takes them apart."""
    rng = random.Random(2)
    long = "".join(rng.choice("abcd é") for _ in range(200_000))
    rows = [*ODD, (10, long), (11, long), (12, long[:-1] + "#"), (13, "#" + long[1:]), *[(20 + i, "hot") for i in range(1500)], *[(3000 + i, f"t{i % 7}") for i in range(20)]]
    out = exact_dedup.exact_duplicates(documents(spark, rows), fields, huge).collect()
    want, groups = brute_exact(rows)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == want
    assert sum(r["kept"] for r in out) == groups
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


def test_fingerprints_compose():
    f = exact_dedup.FIELDS[0]
    table = exact_dedup._falling_powers(*f)
    data = np.random.default_rng(0).integers(0, 256, 5000, dtype=np.uint8)
    whole = exact_dedup.chunk_hash(data, f, table)
    for cut in (0, 1, 2500, 5000):
        a, b = data[:cut], data[cut:]
        assert exact_dedup.combine(exact_dedup.chunk_hash(a, f, table), exact_dedup.chunk_hash(b, f, table), len(b), f) == whole
    x = 0
    for byte in data.tolist():
        x = (x * f[1] + byte) % f[0]
    assert x == whole


def test_drop_exact_duplicates(spark):
    rows = [*ODD, (7, "a"), (8, "a")]
    out = exact_dedup.drop_exact_duplicates(documents(spark, rows))
    assert out.columns == documents(spark, []).columns
    assert sorted((r["text"] or "", r["doc_id"] or -1) for r in out.collect()) == [("", 2), (" \n", 3), ("a", 8), ("a b c", 5), ("b", -1), ("\U0001f600 é", 6)]
    assert exact_dedup.drop_exact_duplicates(documents(spark, [])).count() == 0
    twins = exact_dedup.drop_exact_duplicates(documents(spark, [(1, "z"), (1, "z"), (1, "z")]))
    assert twins.count() == 1


# --- 3 TIFF


@pytest.mark.parametrize("scheme", [tiff.NONE, tiff.PACKBITS, tiff.LZW, tiff.DEFLATE, tiff.DEFLATE_OLD])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tiled", [False, True])
def test_tiff_pages_round_trip(scheme, predictor, tiled):
    rng = np.random.default_rng(scheme)
    pages = [rng.integers(0, 256, (300, 70), dtype=np.uint8), np.zeros((5, 64), np.uint8), rng.integers(0, 3, (130, 65, 3), dtype=np.uint8)]
    data = tiff.write_tiff([(p, scheme, tiled, predictor) for p in pages])
    out = list(tiff.read_tiff(data))
    assert [o["page"] for o in out] == [0, 1, 2]
    for p, o in zip(pages, out, strict=True):
        assert o["samples"] == p.tobytes() and (o["height"], o["width"]) == p.shape[:2] and o["tiled"] == tiled


def test_tiff_big_endian_and_codecs():
    body = bytes(range(64)) * 2
    entries = [(256, 4, 64), (257, 4, 2), (258, 3, 8), (259, 3, 1), (273, 4, 8), (278, 4, 2), (279, 4, 128)]
    ifd = struct.pack(">H", len(entries)) + b"".join(struct.pack(">HHI", t, k, 1) + (struct.pack(">I", v) if k == 4 else struct.pack(">HH", v, 0)) for t, k, v in entries) + b"\0\0\0\0"
    data = b"MM\0*" + struct.pack(">I", 8 + 128) + body + ifd
    assert next(tiff.read_tiff(data))["samples"] == body
    for raw in (b"", b"a", b"aaa", b"aabbb" * 99 + b"x", bytes(1000), bytes(np.random.default_rng(1).integers(0, 256, 70_000, dtype=np.uint8)), b"the cat " * 9000):
        assert tiff.packbits_decode(tiff.packbits_encode(raw), len(raw)) == raw
        assert tiff.lzw_decode(tiff.lzw_encode(raw), len(raw)) == raw


def test_tiff_known_lzw():
    """The example of the format's specification: 7 7 7 8 8 7 7 6 6."""
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    bits = "".join(f"{c:09b}" for c in codes)
    data = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert tiff.lzw_decode(data, 9) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])


def test_tiff_damage_becomes_rows(spark):
    good = tiff.write_tiff([(np.zeros((2, 64), np.uint8), tiff.DEFLATE, False, 1)])
    df = spark.createDataFrame([(1, bytearray(good), "x"), (2, bytearray(good[:30]), "x"), (3, None, "x"), (4, bytearray(b"nonsense"), "x")], "k int, tiff binary, page string")
    out = tiff.tiff_pages(df).collect()
    assert {(r["k"], r["error"] is None) for r in out} == {(1, True), (2, False), (3, False), (4, False)}
    assert tiff.tiff_pages(df.limit(0)).count() == 0


def test_tiff_pages_behind_a_bad_one(spark):
    """A damaged page, and one of 16-bit samples, are rows with an error; the others are read."""
    pages = [np.full((2, 64), i, np.uint8) for i in range(4)]
    data = bytearray(tiff.write_tiff([(p, tiff.DEFLATE, False, 1) for p in pages]))
    mark = struct.pack("<HHI", tiff.STRIP_OFFSETS, 4, 1)
    strips = [struct.unpack_from("<I", data, i + 8)[0] for i in range(len(data)) if data[i : i + 8] == mark]
    data[strips[1]] ^= 0xFF
    bits = [i for i in range(len(data)) if data[i : i + 12] == struct.pack("<HHIHH", tiff.SAMPLE_BITS, 3, 1, 8, 0)]
    data[bits[2] + 8] = 16
    out = tiff.tiff_pages(spark.createDataFrame([(1, data)], "k int, tiff binary")).collect()
    assert [r["page"] for r in out] == [0, 1, 2, 3] and [r["error"] is None for r in out] == [True, False, False, True]
    assert [bytes(out[i]["samples"]) for i in (0, 3)] == [pages[i].tobytes() for i in (0, 3)]


def test_tiff_query(spark, tmp_path):
    rng = random.Random(3)
    rows = [*ODD, (40, words(rng, 30_000)), (41, "x" * 64), (42, "x" * 64)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = tiff.op3_tiff(spark, str(tmp_path)).collect()
    want = Counter()
    for d, t in rows:
        p = tiff.payload((t or "").encode())
        assert len(p) % 64 == 0 and len(p) > 0
        want[(d, len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in out) == want
    by = {r["doc_id"]: r for r in out}
    assert by[41]["feature"] == by[42]["feature"] and by[41]["media_sha256"] == by[42]["media_sha256"]
    assert by[40]["feature"].startswith("pages=") and int(by[40]["feature"].split(";")[0][6:]) > 4


def test_tiff_layouts_do_not_depend_on_size(spark):
    rng = random.Random(31)
    docs = documents(spark, [(i, words(rng, rng.randrange(1, 60))) for i in range(400)])
    pages = tiff.tiff_pages(tiff.payload_tiffs(docs)).groupBy("compression", "tiled").count().collect()
    assert len(pages) == 4 and all(r["count"] > 0.15 * 400 for r in pages)


# --- 4 token store


def test_perfect_hash():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 1000, 50_000):
        h = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        mph = token_store.PerfectHash.build(h)
        assert sorted(mph.slots(h)) == list(range(len(h)))
    twice = np.array([5, 5, 9], np.uint64)
    assert len(token_store.PerfectHash.build(twice).rest) == 2


def test_index_round_trip():
    keys = np.arange(1000, dtype=np.int64) * 7
    lengths = np.arange(1, 1001)
    none = np.zeros(1000, np.int64)
    sink = pa.BufferOutputStream()
    token_store.Index.build(keys, none.astype(bool), none, lengths).write(sink)
    index = token_store.Index.read(pa.BufferReader(sink.getvalue()))
    known, start, n = index.find(keys)
    assert known.all() and (n == lengths).all() and (start == np.cumsum(lengths) - lengths).all()
    foreign, _, _ = index.find(np.arange(1, 100_000, 7))
    assert foreign.sum() <= 1


def test_token_store(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(public_tokenizers.path(token_store.TOKENIZER))
    rng = random.Random(5)
    odd = ["It's <|endoftext|> Don'T", "A<|STARTOFTEXT|>b", "J̌ W̊ É", "ÀÉ.. naïve's 10km a1.b2", "a\x1cb\x85c", "ﬁ ΑΣ Σας İ ß! …x 日本語", "'' \"\" _-_"]
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(odd)], (200, words(rng, 40_000)), *[(300 + i, words(rng, 20)) for i in range(300)]]
    manifest = token_store.write_tokens(documents(spark, rows), work_dir(spark, "t"))
    out = sorted(token_store.read_tokens(manifest).collect(), key=lambda r: r["start"])
    at, got = 0, Counter()
    for r in out:
        assert r["start"] == at
        at += r["n_tokens"]
        got[(r["doc_id"], bytes(r["ids"]))] += 1
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in out]
    assert ids == sorted(ids)
    assert got == Counter((d, array("I", [*tk.encode(t or "", add_special_tokens=False).ids, 1]).tobytes()) for d, t in rows)
    store = token_store.TokenStore(manifest)
    assert store.get(200).tolist() == [*tk.encode(rows[16][1], add_special_tokens=False).ids, 1]
    assert store.get(4, 1) is not None and store.get(4, 2) is None and store.get(99) is None
    assert token_store.read_tokens(token_store.write_tokens(documents(spark, []), work_dir(spark, "t"))).count() == 0


def test_word_encoder_matches_the_library(monkeypatch):
    import public_tokenizers

    enc = token_store.WordEncoder(public_tokenizers.path(token_store.TOKENIZER))
    assert enc.by_words
    rng = random.Random(32)
    bits = [*"aAzZéÉñÇß İıÀÿ÷×'’`´<|>0 12٣漢字кΣﬁ!?.,;:#\t\n\x0b\x1c\x85", "e\u0301", "\u0338", "<|startoftext|>", "'s", " 'LL", "don't", "  ", "ab", "Cd."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 80))) for _ in range(1500)]
    want = [np.array(e.ids, "<u2").tobytes() for e in enc.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert list(enc.encode([t.encode() for t in texts])) == want
    monkeypatch.setattr(token_store, "RUN", 300)  # long texts come in segments
    monkeypatch.setattr(token_store, "REMEMBERED", 50)  # and what is known is forgotten
    assert list(enc.encode([t.encode() for t in texts[:200]])) == want[:200]
    long = " ".join(texts[:50])
    assert list(enc.encode([long.encode()])) == [np.array(enc.tokenizer.encode(long, add_special_tokens=False).ids, "<u2").tobytes()]
    enc.by_words = False  # as with a tokenizer that splits in another way
    assert list(enc.encode([t.encode() for t in texts[:200]])) == want[:200]


# --- 5 mixing


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full, left = {}, set(), float(sum(sizes.values()))
    while True:
        rest = [s for s in names if s not in full]
        total = sum(w[s] for s in rest)
        share = {s: left * w[s] / total for s in rest}
        over = [s for s in rest if share[s] > most * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = float(most * sizes[s])
            full.add(s)
            left -= target[s]


def test_mixing(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, rng.randrange(1, 60)), "en", rng.choice(["a", "a", "a", "b", "c", "é", None, "Z"])) for i in range(3000)]
    rows += [(5000, None, "en", "empty"), (5001, "", "en", "empty"), (None, "x y", "en", "a"), (7, rows[7][1], "en", rows[7][3]), *[(6000 + i, "one", "en", "tiny") for i in range(3)]]
    docs = documents(spark, rows)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows) and "slot" in mixing.mix(docs).columns
    sizes, taken = Counter(), Counter()
    for r in out:
        assert r["size"] == len((r["text"] or "").split())
        assert 0 <= r["copies"] <= 3
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["copies"] * r["size"]
    want = brute_targets({**sizes, "empty": 0})
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        if sizes[s] > 1000:
            assert taken[s] == pytest.approx(want[s], rel=0.1)
    assert taken["tiny"] == 9
    key = lambda rs: sorted((str(r["doc_id"]), r["source"] or "", r["copies"]) for r in rs)
    assert key(out) == key(mixing.mix(docs.repartition(3)).collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in out)
    assert mixing.mix(documents(spark, [])).count() == 0


# --- 6 toxicity


def test_toxicity_learns_and_generalises(spark):
    rng = random.Random(7)
    bad = ["vile", "rotten", "gross", "horrid"]
    rows, labels = [], []
    for i in range(700):
        body = words(rng, rng.randrange(20, 200), 400).split()
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                body.insert(rng.randrange(len(body)), rng.choice(bad))
        rows.append((i, " ".join(body)))
        labels.append((i, 1, toxic))
    rows += [(9001, None), (9002, ""), (9003, " \n"), (9004, words(rng, 60_000, 400)), (9005, words(rng, 30_000, 400) + " vile rotten gross " + words(rng, 30_000, 400)), (1, rows[1][1])]
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, marks)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    s = {r["doc_id"]: r["score"] for r in got}
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((s[i] >= 0.5) == bool(labels[i][2]) for i in held)
    assert right / len(held) > 0.95
    assert s[9001] == s[9002] == s[9003] == 0 and s[9005] > s[9004]
    assert toxicity.learn(docs, marks.limit(0)) is None
    assert {r["score"] for r in toxicity.score(docs.limit(3), None).collect()} == {0.0}
    assert toxicity.score(documents(spark, []), model).count() == 0


def test_toxicity_gradients():
    rng = np.random.default_rng(8)
    p = {k: v.astype(np.float64) for k, v in toxicity.init(rng).items()}
    gates = rng.normal(size=(2, 6, 3, 3 * toxicity.HIDDEN))
    mask = np.ones((6, 3), bool)
    mask[4:, 1] = False
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        q = toxicity.sigmoid(toxicity.forward(p, gates[0], gates[1][::-1], mask))
        return -(y * np.log(q) + (1 - y) * np.log(1 - q)).sum()

    keep = {}
    logit = toxicity.forward(p, gates[0], gates[1][::-1], mask, keep)
    g, gf, gb = toxicity.backward(p, toxicity.sigmoid(logit) - y, mask, keep)
    for name in ("Uf", "Ub", "cf", "Wa", "va", "wo"):
        at = np.unravel_index(3, p[name].shape)
        p[name][at] += 1e-4
        up = loss()
        p[name][at] -= 2e-4
        assert (up - loss()) / 2e-4 == pytest.approx(g[name][at], rel=2e-2, abs=2e-4)
        p[name][at] += 1e-4
    for k, grad in enumerate((gf, gb)):
        gates[k, 2, 0, 5] += 1e-4
        up = loss()
        gates[k, 2, 0, 5] -= 2e-4
        assert (up - loss()) / 2e-4 == pytest.approx(grad[2, 0, 5], rel=2e-2, abs=2e-4)
        gates[k, 2, 0, 5] += 1e-4


def test_windows_cover_every_word():
    for n in range(0, 200):
        first = toxicity.windows(n)
        seen = {i for a in first for i in range(a, min(n, a + toxicity.WINDOW))}
        assert seen == set(range(n))


# --- 7 WARC


def archive(payloads, compressed):
    out, at = b"", []
    for i, p in enumerate(payloads):
        data = warc.record("response", f"urn:page:{i}", "http://x/", p, hashlib.sha256(p).hexdigest())
        if compressed:
            z = zlib.compressobj(6, zlib.DEFLATED, 31)
            data = z.compress(data) + z.flush()
        at.append(len(out))
        out += data
    return bytearray(out), [*at, len(out)]


def salvaged(data):
    kinds, covered, at = [], [], 0
    for x in warc.Salvage(pa.BufferReader(bytes(data))):
        assert x[1] == at
        at = x[2]
        kinds.append(x[0])
        covered.append(x)
    assert at == len(data)
    return covered


@pytest.mark.parametrize("compressed", [False, True])
def test_salvage(compressed):
    rng = random.Random(9)
    payloads = [words(rng, 200 + 50 * i).encode() for i in range(8)]
    data, at = archive(payloads, compressed)
    ids = lambda found: [int(x[3]["warc-record-id"].rsplit(":", 1)[1][:-1]) for x in found if x[0] == "record"]
    gaps = lambda found: [(x[1], x[2]) for x in found if x[0] == "gap"]
    found = salvaged(data)
    assert ids(found) == list(range(8)) and not gaps(found) and all(x[4].endswith(p) for x, p in zip(found, payloads, strict=True))
    hurt = bytearray(data)
    hurt[at[3] + (at[4] - at[3]) // 2] ^= 0xFF
    found = salvaged(hurt)
    assert ids(found) == [0, 1, 2, 4, 5, 6, 7] and gaps(found) == [(at[3], at[4])]
    hurt = data[: at[2]] + data[at[2] + 100 :]
    assert ids(salvaged(hurt)) == [0, 1, 3, 4, 5, 6, 7]
    hurt = data[: at[5]] + bytearray(rng.randbytes(5000)) + data[at[5] :]
    found = salvaged(hurt)
    assert ids(found) == list(range(8)) and gaps(found) == [(at[5], at[5] + 5000)]
    assert ids(salvaged(data[:-20])) == list(range(7))
    assert ids(salvaged(bytearray(b"junk junk") + data)) == list(range(8))
    assert salvaged(bytearray()) == [] and [x[0] for x in salvaged(bytearray(b"nothing here"))] == ["gap"]


def test_warc_query(spark, tmp_path):
    long = "<p>" + "é" * 100
    rows = [(5, "u", long), (3, "u", long), (9, None, long), (None, "u", long), (3, "u", long), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "x" * 100), (8, "u", "WARC/1.1\r\n\r\n" * 20)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    out = warc.op7_warc(spark, str(tmp_path)).collect()
    want = Counter()
    for page, _, html in rows:
        raw = (html or "").encode()
        revisit = html == long and page != 3
        want[(page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None)] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out) == want
    assert warc.read_archives(warc.write_archives(pages.limit(0), work_dir(spark, "w"))).count() == 0


def test_salvage_inside_members():
    """Many records in a member: damage costs the records that it hits, and no other."""
    rng = random.Random(20)
    payloads = [words(rng, 20 + 300 * (i % 7)).encode() for i in range(300)]
    plain, at = archive(payloads, False)
    ids = lambda found: [int(x[3]["warc-record-id"].rsplit(":", 1)[1][:-1]) for x in found if x[0] == "record"]
    read = lambda data: list(warc.Salvage(pa.BufferReader(bytes(data))))

    def member(data, level=6):
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        return z.compress(bytes(data)) + z.flush()

    whole = member(plain)
    found = read(whole)
    assert len(whole) > 4 * warc.PIECE and ids(found) == list(range(300)) and len(found) == 300
    assert all(x[4].endswith(p) for x, p in zip(found, payloads, strict=True))
    assert all(0 <= x[1] < x[2] <= len(whole) for x in found) and found[-1][2] == len(whole)
    # a record that fails its check in a sound member
    hurt = bytearray(plain)
    hurt[at[150] + 300] ^= 0xFF
    hurt[at[200]] ^= 0xFF
    found = read(member(hurt))
    assert ids(found) == [i for i in range(300) if i not in (150, 200)] and [x[0] for x in found].count("gap") == 2
    assert ids(read(member(hurt[: at[160]]) + member(plain[at[160] :]))) == [i for i in range(300) if i != 150]
    # a byte of stored data: zlib goes on to the CRC, which fails
    stored = bytearray(member(plain, 0))
    stored[stored.index(payloads[100][:40]) + 5] ^= 0xFF
    found = read(stored)
    assert ids(found) == [i for i in range(300) if i != 100] and found[-1][0] == "gap"
    # a cut tail: all records before it stay, and the next member is found
    half = whole[: len(whole) // 2]
    kept = ids(read(half))
    assert kept == list(range(len(kept))) and 140 < len(kept) < 160 and read(half)[-1][0] == "gap"
    assert ids(read(half + member(plain[: at[5]]))) == [*kept, *range(5)]
    # zlib stops at a flipped byte
    hurt = bytearray(whole)
    hurt[len(whole) // 2] ^= 0xFF
    found = read(hurt + member(plain[: at[5]]))
    assert ids(found)[: len(kept) - 10] == kept[: len(kept) - 10] and ids(found)[-5:] == list(range(5)) and "gap" in [x[0] for x in found]
    # the CRC only
    hurt = bytearray(whole)
    hurt[-6] ^= 0xFF
    found = read(hurt)
    assert ids(found) == list(range(300)) and [x[0] for x in found].count("gap") == 1 and found[-1][2] == len(whole)
    hurt = bytearray(member(plain[: at[1]]))
    hurt[-6] ^= 0xFF
    assert [x[:3] for x in read(hurt)] == [("gap", 0, len(hurt))]


def test_salvage_holds_a_record_and_a_step():
    """A member that inflates to much more than a step is never held whole."""
    import tracemalloc

    one = warc.record("response", "urn:page:1", "http://x/", b"a" * 1000, hashlib.sha256(b"a" * 1000).hexdigest())
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = z.compress(one * 20_000) + z.flush()
    tracemalloc.start()
    n = sum(x[0] == "record" for x in warc.Salvage(pa.BufferReader(data)))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 20_000 and most < 8 * warc.STEP < len(one) * 20_000 / 10


def test_salvage_checks_sha1_digests():
    import base64

    block = b"some text " * 20
    for told in (base64.b32encode(hashlib.sha1(block).digest()).decode(), hashlib.sha1(block).hexdigest()):
        for b, n in ((block, 1), (b"S" + block[1:], 0)):
            data = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Block-Digest: sha1:{told}\r\nContent-Length: {len(b)}\r\n\r\n".encode() + b + warc.END
            assert sum(x[0] == "record" for x in warc.Salvage(pa.BufferReader(data))) == n


@pytest.mark.parametrize("compressed", [False, True])
def test_warc_long_headers(compressed):
    """Headers of any length are read, whole steps and ends on their edges included."""
    sizes = [10, warc.PIECE - 400, *range(warc.PIECE - 330, warc.PIECE - 300), warc.PIECE, warc.PIECE + warc.STEP, 3_000_000, 10]
    data = b""
    for i, n in enumerate(sizes):
        one = warc.record("response", f"urn:page:{i}", "http://x/" + "y" * n, b"page", hashlib.sha256(b"page").hexdigest())
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        data += z.compress(one) + z.flush() if compressed else one
    found = salvaged(data)
    assert [(x[0], x[3]["warc-record-id"], len(x[3]["warc-target-uri"])) for x in found] == [("record", f"<urn:page:{i}>", 9 + n) for i, n in enumerate(sizes)]


def test_warc_query_keeps_long_urls_and_raises_on_gaps(spark, tmp_path, monkeypatch):
    rows = [(1, "http://x/" + "é" * 70_000, "<p>" * 50), (2, "u", "<p>" * 50), (3, "u", "other")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    out = warc.op7_warc(spark, str(tmp_path)).collect()
    assert {(r["page_id"], r["record_type"], r["refers_to"]) for r in out} == {(1, "response", None), (2, "revisit", 1), (3, "response", None)}
    write = warc.write_archives

    def hurt(*args):
        names = write(*args)
        path = names.first()["archive"].removeprefix("file://").removeprefix("file:")
        with open(path, "r+b") as f:
            f.seek(40)
            f.write(b"damage")
        return names

    monkeypatch.setattr(warc, "write_archives", hurt)
    with pytest.raises(Exception, match="gap in "):
        warc.op7_warc(spark, str(tmp_path)).collect()


# --- 8 near dedup


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_near(rows):
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_rows(rng):
    rows, passage = [], words(rng, 60)
    for i in range(40):
        rows.append((len(rows), words(rng, 100) + " " + passage))
    for _ in range(30):
        base = words(rng, rng.randrange(30, 300)).split()
        for _ in range(rng.randrange(2, 6)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(copy) // 20))):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    chain = words(rng, 200).split()
    for i in range(40):  # each near the one before, the ends far apart
        rows.append((len(rows), " ".join(chain)))
        chain = chain[8:] + words(rng, 8).split()
    rows += [(len(rows) + i, t) for i, t in enumerate(["", None, "a b", "A  B", "a b c d e", "A B\tc d\x0be", "\x1c  "])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("per_block", [near_dedup.PER_BLOCK, 7])
def test_near_duplicates(spark, per_block, monkeypatch):
    monkeypatch.setattr(near_dedup, "PER_BLOCK", per_block)
    rows = near_rows(random.Random(10))
    want = brute_near(rows)
    out = near_dedup.near_duplicates(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == want and len(out) == len(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_near_duplicates_odd(spark):
    rows = [*ODD, (50, "one two three four five six"), (51, "One two three four five six"), (None, "one two three four five six"), (51, "One two three four five six")]
    out = near_dedup.near_duplicates(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    assert Counter((r["doc_id"], r["component_id"]) for r in out)[(51, 50)] == 2
    assert all(r["component_id"] is None and r["kept"] for r in out if r["doc_id"] is None)
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0
    kept = near_dedup.drop_near_duplicates(documents(spark, rows))
    assert kept.columns == documents(spark, []).columns and kept.count() == len(rows) - 2


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(36)
    for n in (1, 5, 50, 2000):
        a, b = (np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for _ in range(2))
        both = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        x, y = np.union1d(a, both), np.union1d(b, both)
        bits = np.bitwise_count(near_dedup._sketch(x) ^ near_dedup._sketch(y)).sum()
        assert 0 < bits <= len(np.setxor1d(x, y)) and len(near_dedup._sketch(x)) * 64 == near_dedup.SKETCH
        assert not (near_dedup._sketch(x) ^ near_dedup._sketch(x.copy())).any()


def test_hot_members_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(near_dedup.hot_values, "__defaults__", (3,))
    rows = near_rows(random.Random(37))
    out = near_dedup.near_duplicates(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute_near(rows)


def test_crowds_of_near_copies_do_not_emit_all_pairs(spark, monkeypatch):
    """Copies of one text with a word changed, behind copies that are near to all of them and linked with few: those of one component don't all meet each other."""
    seen = []
    monkeypatch.setattr(near_dedup, "CROWD", 4, raising=False)
    monkeypatch.setattr(near_dedup, "_confirmed", lambda pairs, *more, f=near_dedup._confirmed: seen.append(pairs.count()) or f(pairs, *more))
    rng = random.Random(38)
    base = words(rng, 60, 10**6).split()
    changed = lambda i, places: " ".join(f"changed{i}x{j}" if j in places else w for j, w in enumerate(base))
    rows = [(i, changed(i, rng.sample(range(60), 4))) for i in range(100)] + [(i, changed(i, [rng.randrange(20, 30)])) for i in range(100, 180)]
    out = near_dedup.near_duplicates(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute_near(rows)
    assert seen[-1] < len(rows) and sum(seen[1:]) < 1200


def test_signature_join_finds_all_within_the_distance():
    rng = np.random.default_rng(11)
    for _ in range(200):
        a = rng.integers(0, 1 << near_dedup.BITS, near_dedup._N)
        b = a.copy()
        wrong = rng.permutation(near_dedup._N)[: near_dedup.DISTANCE]
        b[wrong] += 1
        chunks = (a != b).reshape(near_dedup.CHUNKS, near_dedup.PER_CHUNK).sum(1)
        assert chunks.min() <= near_dedup.ERRORS


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    rng = random.Random(12)
    texts = [words(rng, n).encode() for n in (0, 1, 500, 3, 0, 2000)] + [b"x" * 5000 + b" y", b"  "]
    data, offsets = _bytes.utf8(pa.array(texts, pa.binary()))

    def run():
        return [h[b[i] : b[i + 1]].tolist() for first, last, h, b in _bytes.word_hashes(data, offsets) for i in range(last - first)]

    whole = run()
    monkeypatch.setattr(_bytes, "BLOCK", 700)
    assert run() == whole and [len(x) for x in whole] == [len(t.split()) for t in texts]


def test_components(spark):
    rng = random.Random(13)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)] + [(200, 300 + i) for i in range(50)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    out = {r["vertex"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {v: find(v) for v in list(root) if find(v) != v}


# --- 9 BPE


def test_bpe_round_trip(spark):
    import public_tokenizers

    enc = bpe.encoding(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
    rng = random.Random(14)
    long = [words(rng, 40_000), "x" * 150_000, " " * 70_000 + "a" + " \n" * 40_000, "a  b\n\nc  d'll  " * 9000, "日本語テキスト" * 12_000]
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(long)], (200, "<|endoftext|>")]
    out = bpe.round_trip(documents(spark, rows)).collect()
    want = Counter()
    for d, t in rows:
        ids = enc.encode_ordinary(t or "")
        want[(d, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), sha(t))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out) == want
    assert bpe.round_trip(documents(spark, [])).count() == 0


def test_bpe_pieces_keep_matches():
    import public_tokenizers
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(15)
    for _ in range(300):
        text = "".join(rng.choice("ab1.' \n\t  é's") for _ in range(200))
        parts = list(bpe.pieces(text, 20))
        assert "".join(parts) == text and [m for p in parts for m in pattern.findall(p)] == pattern.findall(text)


# --- 10 language ID


def speech(rng, lang, n=40):
    parts = {"aa": ["bla", "blu", "ka", "kor"], "bb": ["été", "sol", "mi", "rou"], "cc": ["zch", "ung", "wo", "tra"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_language_id(spark):
    rng = random.Random(16)
    rows = [(i, speech(rng, lang, rng.randrange(2, 80)), lang) for i in range(600) for lang in [rng.choice(["aa", "bb", "cc"])]]
    long = [(2000, speech(rng, "bb", 300_000), "bb")]
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 --- !!", None), (1003, "一", None), (None, speech(rng, "cc"), None), (1, rows[1][1], "aa"), (1004, "² ①", None)]
    docs = documents(spark, rows + odd + long)
    out = langid.languages(docs, "lang_pred", "lang_score").collect()
    assert len(out) == len(rows) + len(odd) + 1
    by = {r["doc_id"]: r for r in out}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(by[r[0]]["lang_pred"] == r[2] for r in held) / len(held) > 0.97
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002, 1004)] == ["und"] * 4 and by[1003]["lang_pred"] != "und"
    assert by[None]["lang_pred"] == "cc" and by[2000]["lang_pred"] == "bb" and all(0 <= r["lang_score"] <= 1 for r in out)
    kept = langid.drop_unknown(docs)
    assert kept.columns == docs.columns and kept.count() == len(out) - 4
    assert langid.languages(documents(spark, []), "p", "s").count() == 0
    assert {r["p"] for r in langid.languages(documents(spark, [(1, "abc", None)]), "p", "s").collect()} == {"und"}


def test_bloom_filters_hold_every_member_and_many_languages():
    rng = np.random.default_rng(17)
    values = rng.integers(0, 2**32, 70 * 50, dtype=np.uint32)
    members = np.arange(len(values)) % 70
    m = langid.build([f"l{i}" for i in range(70)], members, values)
    hits = m.hits(np.zeros(len(values), np.int64), values, 1)
    assert (hits[:, 0] >= 50).all() and (m.false_rate < 0.01).all()
    for i in (0, 63, 64, 69):
        own = values[members == i]
        assert m.hits(np.zeros(len(own), np.int64), own, 1)[i, 0] == len(own)


def test_grams_do_not_cross_rows(monkeypatch):
    texts = [b"abcd", b"ab", b"", b"efgh ijk" * 50]
    data, offsets = _bytes.utf8(pa.array(texts, pa.binary()))
    count = lambda: Counter((int(r), int(g)) for rows, grams in langid.blocks(data, offsets) for r, g in zip(rows, grams, strict=True))
    whole = count()
    assert {r for r, _ in whole} == {0, 3} and sum(n for (r, _), n in whole.items() if r == 3) == 397
    monkeypatch.setattr(langid, "_BLOCK", 10)
    assert count() == whole


def test_langid_query(spark, tmp_path):
    rng = random.Random(33)
    rows = [(i, speech(rng, lang, 30), lang) for i in range(300) for lang in [rng.choice(["aa", "bb", "cc"])]] + [(900, None, "aa"), (901, "12 !", None)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = langid.op10_langid(spark, str(tmp_path))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(rows) and all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [r for r in rows[:300] if got[r[0]]["held_out"]]
    assert sum(got[d]["lang_pred"] == lang for d, _, lang in held) / len(held) > 0.97
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und"


def test_toxicity_query(spark, tmp_path):
    rng = random.Random(34)
    rows = [(i, words(rng, 60, 300) + (" vile rotten gross" if i % 4 == 0 else "")) for i in range(400)] + [(900, None)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = toxicity.op6_toxicity(spark, str(tmp_path))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(rows) and all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got.values())
    held = [d for d in range(400) if got[d]["held_out"]]
    assert sum(got[d]["predicted"] == int(d % 4 == 0) for d in held) / len(held) > 0.95


# --- columns that clash

EXTRA = ["a.b", "size", "source_size", "copies", "target", "mix", "_source", "found", "lang_pred", "_lettered", "ids", "c0", "_part", "idx", "copy"]


@pytest.mark.parametrize("operator", ["language", "exact", "near", "mixing", "encoding"])
def test_other_columns_stay(spark, operator):
    import public_tokenizers

    rng = random.Random(35)
    rows = [(i, words(rng, 30), "en", "s") for i in range(20)] + [(50, None, None, None)]
    docs = documents(spark, rows)
    for i, name in enumerate(EXTRA):
        docs = docs.withColumns({name: F.lit(1000 + i)})
    make = {
        "language": langid.drop_unknown,
        "exact": exact_dedup.drop_exact_duplicates,
        "near": near_dedup.drop_near_duplicates,
        "mixing": mixing.mixed_documents,
        "encoding": lambda d: bpe.encode_documents(d, public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN),
    }[operator]
    out = make(docs)
    names = [n for n in EXTRA if operator != "encoding" or n != "ids"]
    if operator != "encoding":
        assert out.columns == docs.columns
    seen = out.select(*[F.col(f"`{n}`").alias(f"x{i}") for i, n in enumerate(names)]).distinct().collect()
    assert [tuple(r) for r in seen] == [tuple(1000 + EXTRA.index(n) for n in names)]


# --- pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    import public_tokenizers

    rng = random.Random(18)
    rows = near_rows(rng) + [(5000 + i, words(rng, 50)) for i in range(30)] + [(6000, "123"), (6001, "..."), (6002, None)]
    rows += [(7000 + i, rows[3][1]) for i in range(5)]
    full = [(d, t, "en", "abc"[i % 3]) for i, (d, t) in enumerate(rows)]
    documents(spark, full).write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "near dedup", "mixing", "byte-level BPE"]
    out = Counter((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    left = [r for r in full if any(c.isalpha() for c in r[1] or "")]
    last = {}
    for r in left:
        last[r[1]] = max(last.get(r[1], r), r)
    left = list(last.values())
    near = brute_near([(r[0], r[1]) for r in left])
    left = [r for r in left if near[r[0]][1] == r[0]]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(documents(spark, left)).collect()}
    enc = bpe.encoding(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
    want = Counter()
    for d, t, *_ in left:
        if copies[d]:
            want[(d, len(enc.encode_ordinary(t)), sha(t))] = copies[d]
    assert out == want


def test_pipeline_without_labels(spark, tmp_path):
    """No label, so no language is learned: documents with a letter all reach the end."""
    import corpus_pipeline

    rng = random.Random(19)
    rows = [(i, words(rng, 50), None) for i in range(30)] + [(100, "123", None), (101, None, None), (102, "一 é", None)]
    docs = documents(spark, rows)
    assert sorted(r["doc_id"] for r in langid.drop_unknown(docs).collect()) == [*range(30), 102]
    thin = [(200 + i, f"{x} {x}", "aa") for i, x in enumerate("abc")]  # no n-gram twice, so still nothing is learned
    assert not langid.learn(documents(spark, thin)).languages
    assert sorted(r["doc_id"] for r in langid.drop_unknown(documents(spark, rows + thin)).collect()) == [*range(30), 102, 200, 201, 202]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs.where("doc_id not in (100, 101)")).collect()}
    assert Counter(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == Counter(copies)
