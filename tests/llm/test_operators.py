"""The training-data operators against brute force on small fixtures: nulls, empty
and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlake.llm import decontam, fingerprints, jaccard, langid, lm, packing, quality, sharding, toxicity, warc
from martlake.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, cls string, fp string, n int, row string"
BASE = ("the quick brown fox jumps over the lazy dog while seven wise owls count silver coins near an old stone mill "
        "under pale moonlight and quiet rivers carry fallen leaves toward distant shores where tired sailors mend nets "
        "before dawn breaks softly across green hills").split()


def texts():
    long = " ".join(f"w{i % 701}x{i % 13}" for i in range(6000))
    near = BASE[:-1] + ["mountains"]
    return [(0, " ".join(BASE)), (1, " ".join(BASE)), (2, " ".join(near)), (3, None), (4, ""), (5, "two words"),
            (6, "Two  WORDS"), (7, long), (8, long + " tail"), (9, "   \n"), (10, "été déjà vu à la fenêtre ouverte"),
            (11, " ".join(reversed(BASE))), (12, "a"), (12, "a"), (13, "one! two? three's <|endoftext|> x_y 12.5"),
            (None, " ".join(BASE)), (None, "nobody"), (14, " ".join(BASE[:20] + ["odd"] * 40))]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i is None or i % 2 else "fr", f"src{(i or 0) % 3}", "x", "y", 1, "z") for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def test_fingerprints(docs, empty):
    rows = fingerprints.edit_likeness(docs).collect()
    assert len(rows) == len(texts())
    order = sorted((r for r in texts() if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    want = Counter()
    for i, (doc_id, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        q = len(t) // 4
        want[doc_id, len(t), hashlib.sha256((t[: len(t) - q] + nxt[:q]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows if r.doc_id is not None) == want
    by = {r.doc_id: r for r in rows}
    assert by[0].fingerprint == by[1].fingerprint and by[0].near_next == 1.0
    assert by[1].near_next > 0.5 and by[5].near_next < 1.0 and by[3].fingerprint == by[4].fingerprint
    assert 0.2 < by[7].near_edited <= 1.0
    assert fingerprints.edit_likeness(empty).count() == 0
    moved = fingerprints.codes_of(" ".join(BASE[20:] + BASE[:20]))
    a, b = (fingerprints.signature(x) for x in (fingerprints.codes_of(" ".join(BASE)), moved))
    assert fingerprints.likeness(a, a) == 1.0 and fingerprints.likeness(a, b) < 1.0


def test_warc_round_trip(spark):
    url = "http://www.Example.com:80/A?b=1#c"
    rows = [(1, url, "same"), (2, url, "same"), (3, None, None), (4, "not a url", ""), (5, "https://x.org/é", "é" * 5000),
            (6, "http://h.example/p", "same")] + [(100 + i, f"http://h{i % 7}.example/{i}", f"page {i}") for i in range(700)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("clash"))
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        first.setdefault(h or "", i)
    for i, _, h in rows:
        payload, lead = (h or "").encode(), first[h or ""]
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(payload), warc.payload_digest(payload))
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if lead == i else ("revisit", lead))
    assert warc.url_key(url) == "com,example)/a?b=1" and warc.url_key(None) == ""
    assert warc.round_trip(pages.limit(0)).count() == 0
    assert {r.record_type for r in warc.round_trip(pages, min_payload=5).where("page_id < 5").collect()} == {"response"}


def test_warc_keys_without_a_host_repeated_and_null_pages(spark):
    odd = [c + "b" + d for c in ("a", "a ", "a\t", "a\n", "a%", "a%09", "a!") for d in ("", "\t", "\n", " x")]
    rows = [(i, u, f"page {i % 9}") for i, u in enumerate(odd * 30)]
    rows += [(3, odd[3], "page 3"), (3, odd[3], "page 3"), (3, odd[5], "another"), (None, "http://h.example/", "x"), (None, None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = warc.round_trip(pages).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter(
        (i, len(h), warc.payload_digest(h.encode())) for i, _, h in rows)
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in got)
    first = warc.record_bytes(5, "u", b"x", warc.payload_digest(b"x"), 1, None, False)
    again = warc.record_bytes(8, "v", b"x", warc.payload_digest(b"x"), 1, 5, True)
    assert warc.parse_record(again)[0]["WARC-Refers-To"] == warc.parse_record(first)[0]["WARC-Record-ID"]


def test_toxicity(spark, empty):
    rows = [(i, " ".join(BASE[i % 9: i % 9 + 15]) + (" vile scoundrel" * (1 + i % 4) if i % 5 == 0 else "")) for i in range(300)]
    d = spark.createDataFrame(rows + [(900, None), (901, ""), (902, "vile scoundrel vile")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.severity(d, labels).collect()}
    assert len(got) == 303 and all(got[i].toxic == (i % 5 == 0) for i in range(300))
    assert got[902].toxic and not got[900].toxic and got[900].severity == got[901].severity
    assert got[15].severity > got[0].severity > got[1].severity
    assert toxicity.severity(d, labels.limit(0)).where("severity > 0").count() == 0
    assert toxicity.severity(empty, labels).count() == 0


def jump(key, shards):
    b, j, key = -1, 0, key % 2 ** 64
    while j < shards:
        b, key = j, (key * sharding.MULTIPLIER + 1) % 2 ** 64
        j = int((b + 1) * (2 ** 31 / ((key >> 33) + 1)))
    return b


def test_sharding(spark, docs, empty):
    keys = [0, 1, -1, 2 ** 63 - 1, -2 ** 63, *range(2, 3000, 7)]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_shard(F.col("k"), 24).alias("s"))
    assert all(r.s == jump(r.k, 24) for r in got.collect())
    rows = sharding.shard_rows(docs, 24, lanes=3).collect()
    assert len(rows) == len(texts())
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert all(r.grown_shard in (r.shard, 24) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts())
    assert sharding.shard_rows(empty, 24).count() == 0


def shingles(text, n):
    w = words(text)
    return {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard(spark, docs, empty, n, percent):
    rows = [r for r in texts() if r[0] is not None] + [
        (100 + i, " ".join([*BASE[:30], *(f"v{i}x{j}" for j in range(i % 6))])) for i in range(40)]
    got = {r.doc_id: r for r in jaccard.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), n=n, percent=percent).collect()}
    sets = {i: shingles(t, n) for i, t in rows}
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    for i in sets:
        assert (got[i].n_shingles, got[i].component_id) == (len(sets[i]), root(i)), i
    full = jaccard.near_duplicates(docs, n=n, percent=percent).collect()
    assert len(full) == len(texts()) and {r.component_id for r in full if r.doc_id is None} == {0, None}
    kept = [r.doc_id for r in jaccard.keep_one(docs, n, percent).collect() if r.doc_id is not None]
    assert len(kept) == len(set(kept)) and {0, 3, 4, 5, 7} <= set(kept) and not {1, 6} & set(kept)
    assert jaccard.near_duplicates(empty).count() == 0


def test_quality(spark, docs, empty):
    rows = [(i, (" ".join(BASE[i % 9: i % 9 + 15]) if i % 3 else "### $$$ " * 20), "en", f"s{i % 4}") for i in range(300)]
    d = spark.createDataFrame([*rows, (900, None, None, None), (901, "", "en", "new")], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)] + [(None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify(d, labels).collect()}
    assert len(got) == 302 and all(got[i].keep == (i % 3 > 0) for i in range(300))
    assert {r.doc_id for r in quality.keep_good(d, labels).collect()} >= {i for i in range(300) if i % 3}
    assert quality.classify(empty, labels).count() == 0 and quality.classify(docs, labels.limit(0)).count() == len(texts())
    mean, strength = quality.prior_moments(80.0, 100.0, 2, 66.0, 5000.0)
    assert mean == pytest.approx(0.8) and strength > 0


def test_decontamination(spark, docs, empty):
    short, plain = "Pale moon, over", " ".join(BASE[5:25])
    items = [(1, " ".join(BASE[3:30])), (2, short), (3, None), (4, ""), (5, " ".join(BASE[3:30])), (None, "nobody")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("kind", F.lit(1))
    more = [(200, f"start {plain} end"), (201, "say pale MOON over; pale moon over"), (202, " ".join(BASE[5:16])),
            (203, "zzz " * 500 + " ".join(BASE[4:18]))]
    rows = [r for r in texts() if r[0] not in (12, None)] + more
    got = {r.doc_id: r for r in decontam.contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = {}
    for i, t in items:
        w = words(t, pattern)
        for p in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[p: p + 13]), set()).add(i)
    for i, t in rows:
        w, hit, found = words(t, pattern), set(), set()
        for size in {len(x) for x in windows}:
            for p in range(len(w) - size + 1):
                if tuple(w[p: p + size]) in windows:
                    hit |= set(range(p, p + size))
                    found |= windows[tuple(w[p: p + size])]
        names = sorted(str(x) for x in found if x is not None)
        assert (got[i].n_words, got[i].n_hit, got[i].n_items) == (len(w), len(hit), len(names)), i
        assert got[i].items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert got[i].contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    assert decontam.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.contamination(empty, bench).count() == 0
    assert 200 not in {r.doc_id for r in decontam.drop_contaminated(spark.createDataFrame(more, "doc_id long, text string"), bench).collect()}


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= n]
        if fit:
            rooms[min(fit, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return Counter(rooms)


def test_packing(docs, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    more = [(500, "one <|endoftext|> two <|startoftext|>"), (501, "a<|ENDOFTEXT|>b " * 3), (502, "<|endoftext|>"), (503, "<|endoftext"),
            (504, " ".join(BASE) + "<|startoftext|>"), (505, "plain"), (506, "|><|endof text|>")]
    docs = docs.unionByName(docs.sparkSession.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True).coalesce(2)
    assert {49406, 49407} <= set(tok.encode(more[0][1], add_special_tokens=False).ids)
    rows = packing.pack(docs, tokenizer_path(), lanes=3).collect()
    want = Counter()
    for i, t in [*texts(), *more]:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for k, s in enumerate(range(0, len(ids), 2048)):
            raw = b"".join(x.to_bytes(4, "little") for x in ids[s: s + 2048])
            want[i, k, s, len(raw) // 4, zlib.crc32(raw)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert r.offset == seqs.get(r.sequence_id, 0)
        seqs[r.sequence_id] = r.offset + r.length
    assert Counter(2048 - n for n in seqs.values()) == best_fit([r.length for r in rows], 2048)
    assert packing.pack(empty, tokenizer_path()).count() == 0


@pytest.mark.parametrize("counts", [{5: 7, 3: 9, 2: 4}, {10: 3, 7: 5, 4: 6, 3: 11, 1: 8}, {1: 40}, {16: 2, 9: 5, 8: 5, 7: 5}])
def test_packing_plan_is_best_fit_decreasing(counts):
    rooms, placed = Counter(), Counter()
    for length, _, number, first, _ in packing.plan(dict(counts), 16).tolist():
        placed[length] += number
        for s in range(first, first + number):
            rooms[s] += length
    assert placed == Counter(counts)
    assert Counter(16 - n for n in rooms.values()) == best_fit([x for x, n in counts.items() for _ in range(n)], 16)


def test_language(spark, docs, empty):
    fr = "le petit chat gris dort sur une chaise pendant que la pluie tombe dans le jardin vide".split()
    rows = [(i, " ".join((BASE if i % 2 else fr)[j % 11] for j in range(i, i + 40)), "en" if i % 2 else "fr") for i in range(120)]
    d = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 34 !!", "fr"), (902, "sur la chaise grise", None)],
                              "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in langid.identify(d).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[902].lang_pred == "fr"
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    assert langid.identify(docs).count() == len(texts()) and langid.identify(empty).count() == 0
    assert {r.doc_id for r in langid.keep_language(d).collect()} == set(got) - {900, 901}


def phrases(text, other):
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i: j + 1] in other:
            j += 1
        n, i = n + 1, j
    return n


def test_cross_parsing_counts_longest_matches():
    model = langid.Model({"a": ["abracadabra abacus"], "b": ["banana bandana cabana"]})
    text = "abraban bandanacab"
    h, n = model.entropies([text])
    for k, (lang, sample) in enumerate((("a", "abracadabra abacus "), ("b", "banana bandana cabana "))):
        assert model.langs[k] == lang
        largest = len("banana bandana cabana ")  # one normaliser for all languages
        assert h[k][0] == pytest.approx(phrases(text, sample) * math.log2(largest) / n[0])


FR = "le petit chat gris dort sur une chaise pendant que la pluie tombe dans le jardin vide".split()


def labelled(n=120, length=40):
    return [(i, " ".join((BASE if i % 2 else FR)[j % 11] for j in range(i, i + length)), "en" if i % 2 else "fr") for i in range(n)]


def predicted(spark, rows):
    return {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}


def test_a_language_with_little_text_does_not_win(spark):
    unseen = [(900, "the brown fox counts old coins near the mill", None), (901, "le chat dort dans le jardin", None)]
    sparse = next(i for i in range(500, 600) if zlib.crc32(str(i).encode()) % 5)
    got = predicted(spark, [*labelled(), *unseen, (sparse, "ok", "xx")])
    assert (got[900].lang_pred, got[901].lang_pred) == ("en", "fr")
    assert sum(r.lang_pred == "xx" for r in got.values()) <= 1


def test_a_language_with_long_documents_only_is_learned(spark):
    rows = [(i, t if lang == "en" else " ".join([t] * 120), lang) for i, t, lang in labelled(80)]
    assert min(len(t) for _, t, lang in rows if lang == "fr") > langid.SAMPLE_CHARS
    got = predicted(spark, rows)
    assert all(got[i].lang_pred == lang for i, _, lang in rows)


def test_letters_of_every_script_keep_apart(spark):
    def spelled(first, size):
        return [(first + i, " ".join(chr(start + (7 * i + 3 * j + k) % size) for j in range(30) for k in range(3)), f"l{start:x}")
                for n, start in enumerate((0x4E00, 0x5E00, 0x0430, 0xAC00)) for i in range(n * 30, n * 30 + 30)]
    rows = spelled(0, 25)
    got = predicted(spark, rows)
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    letters = langid.Letters(Counter({chr(0x4E00 + i): 1000 - i for i in range(600)}))
    seen = {tuple(letters(langid._codes(chr(0x4E00 + i)), np.array([0, 1]))[0]) for i in range(600)}
    assert len(seen) == 600


def test_languages_of_one_document_and_none(spark):
    one = predicted(spark, [(i, "only one tongue here", "en") for i in range(20)])
    assert all(r.lang_pred == "en" and r.score == 1.0 for r in one.values())
    rows = spark.createDataFrame([(1, "words", None), (2, "12 !", None), (3, None, None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(rows).collect()} == {"und"}
    assert [r.doc_id for r in langid.keep_language(rows).collect()] == [1]
    assert langid.keep_language(rows.limit(0)).count() == 0


def test_language_model(docs, empty):
    rows = lm.score(docs, buckets=3).collect()
    assert len(rows) == len(texts())
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts()]
    train = Counter(w for (_, t), h in zip(texts(), held, strict=True) if not h for w in [*words(t), None])
    n, v = sum(train.values()), len(train)
    want = Counter()
    for (i, t), h in zip(texts(), held, strict=True):
        tok = [*words(t), None]
        want[i, h, len(tok), sum(train[w] > 0 for w in tok), n, round(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in tok), 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert all(r.score < 0 for r in rows)
    assert lm.score(empty).count() == 0


def brute_force_model(train, held):
    """log10 probability of the held-out text by dictionaries: counts of every context,
    Witten-Bell towards the suffix, longest retained context."""
    depth, seen = lm.DEPTH, {}
    spelled = [b"\n" * depth + " ".join(words(t)).encode() + b"\n" for t in train]
    for t in spelled:
        for i in range(depth, len(t)):
            for d in range(depth + 1):
                seen.setdefault(t[i - d:i], Counter())[t[i]] += 1

    def p(ctx, b):
        c = seen.get(ctx, Counter())
        if not ctx:
            return (c[b] + 1) / (c.total() + 256)
        base = p(ctx[1:], b)
        return (c[b] + len(c) * base) / (c.total() + len(c)) if c.total() >= lm.MIN_COUNT else base

    kept = set()
    for ctx, c in seen.items():
        gain = sum(k * math.log2(k / c.total() / p(ctx[1:], b)) for b, k in c.items()) if ctx else 0
        if c.total() >= lm.MIN_COUNT and (len(ctx) <= lm.KEPT or gain > lm.GAIN_BITS * len(c)):
            kept |= {ctx[j:] for j in range(len(ctx) + 1)}
    t, total = b"\n" * depth + " ".join(words(held)).encode() + b"\n", 0.0
    for i in range(depth, len(t)):
        d = max(d for d in range(depth + 1) if d == 0 or t[i - d:i] in kept)
        total += math.log10(p(t[i - d:i], t[i]))
    return total, max(map(len, kept))


def test_model_keeps_every_context_above_an_absolute_count(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    own = [i for i in range(300) if zlib.crc32(str(i).encode()) % 7 != 2][:120]
    rare = "zebra quartz"  # eight times or so among many other texts
    text = {i: " ".join(f"{BASE[(i * 7 + j * j) % len(BASE)]}" for j in range(40 + i % 9)) + (f" {rare}" if n % 13 == 0 else "")
            for n, i in enumerate(own)}
    asked = f"the quick {rare} unseen été fox"
    rows = spark.createDataFrame([*text.items(), (held, asked)], "doc_id long, text string").repartition(3)
    want, longest = brute_force_model(list(text.values()), asked)
    for buckets in (1, 5):
        got = [r.score for r in lm.score(rows, buckets=buckets).collect() if r.held_out]
        assert got == [pytest.approx(want, rel=1e-5)]
    assert longest == lm.DEPTH >= 7
    assert len(lm.dense_contexts(rows)) > 20  # most contexts of this small corpus are split over buckets
    assert not hasattr(lm, "MIN_SHARE")  # no floor that rises with the corpus
