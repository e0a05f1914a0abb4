"""Decontamination, personal data, sharding, packing and the trained operators."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import brute
from tarmac.llm import decontaminate, language, pack, pii, quality, shard, toxicity
from tarmac.llm.queries import QUERIES

EMPTY = hashlib.sha256(b"").hexdigest()


# -- benchmark decontamination

def test_decontamination_on_the_tables(spark):
    got = [tuple(r) for r in QUERIES["op4_decontaminate"](spark, brute.SF).collect()]
    want = brute.contamination(brute.rows("documents", "doc_id, text"), brute.rows("benchmark", "item_id, text"))
    assert sorted(got) == sorted(want)


def test_benchmark_parts_are_read_one_after_the_other(spark, docs_of, monkeypatch):
    """From the third on, a part is read when the scan of the one before is stored; long items are split."""
    words = [f"b{i}" for i in range(130)]
    bench = spark.createDataFrame([("long", " ".join(words)), *((f"i{j}", f"some item number {j} of few words") for j in range(9))],
                                  "item_id string, text string")
    docs = docs_of([(1, "x " + " ".join(words[17:60]) + " y"), (2, " ".join(words[38:48])), (3, "some item number 7 of few words"),
                    (4, "nothing at all"), (5, " ".join(words[120:]) + " z")])
    want = sorted(map(tuple, decontaminate.contamination_report(docs, bench).collect()))
    assert [r[2] for r in want] == [43, 10, 7, 0, 10]
    events, parts, stored = [], decontaminate._parts, decontaminate.stored

    def read(*a):
        for part in parts(*a):
            assert sum(len(t.split()) for _, t in part) < 2 * 20 + 9
            events.append("part")
            yield part

    monkeypatch.setattr(decontaminate, "_parts", read)
    monkeypatch.setattr(decontaminate, "stored", lambda df, name: (events.append(name), stored(df, name))[1])
    got = sorted(map(tuple, decontaminate.contamination_report(docs, bench, 20).collect()))
    assert got == want and events.count("part") > 5
    assert events[:3] == ["part", "part", "decontaminate-rows"]
    assert events[3:6] == ["decontaminate-part"] * 2 + ["part"]
    assert all(a != b for a, b in zip(events[5:], events[6:], strict=False))


@pytest.mark.parametrize("part_words", [1_000_000, 3])
def test_decontamination_odd_rows(spark, clashing, no_docs, part_words):
    items = [(10, "Same text, here again!"), (9, "TWO words"), (9, "two WORDS"), (None, "déjà vu"), (3, None), (4, ""),
             (5, " ".join(f"w{i}" for i in range(100, 112)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    got = [tuple(r) for r in decontaminate.contamination_report(clashing, bench, part_words).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(got, key=key) == sorted(brute.contamination(docs, items), key=key)
    clean = decontaminate.remove_contaminated(clashing, bench, part_words)
    assert clean.columns == clashing.columns
    assert {r.doc_id for r in clean.collect()} == {1, 2, 3, 4, 10, 11, 12, None}
    assert decontaminate.contamination_report(no_docs, bench).collect() == []
    none = decontaminate.contamination_report(clashing, bench.limit(0)).collect()
    assert len(none) == 14 and not any(r.contaminated for r in none) and {r.items_sha256 for r in none} == {EMPTY}


# -- personal data

SAMPLES = [
    "a@b.c_d@e.f x@y.z@q.r ..@--.-- a@b a@.b user@host.example.com.", "1.2.3.4.5 256.1.1.1 001.002.003.004 1.2.3 9.9.9.9",
    "4111 1111 1111 1111, 4111-1111-1111-1112 5500005555555559 1234 56  7890", "+1 (555) 010-9999 ++49 30 123456 +1-",
    "é+33 1 23 45 67 89 \U0001f600 mail me: x.y+z@mail.example.org 10.0.0.1", "1" * 40, "1 " * 40, "+" * 30 + "1" * 12,
    "call 555-123-4567 or write jane (at) example (dot) com; card 4111111111111112", "a@" * 50 + "b.c"]


def test_base_spans(docs_of):
    rnd = random.Random(5)
    texts = SAMPLES + ["".join(rnd.choice("a1 9.@-+()é") for _ in range(rnd.randrange(90))) for _ in range(400)]
    got = {r.doc_id: r for r in pii.find_personal_data(docs_of(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        spans = brute.base_spans(t)
        n = Counter(k for _, k, _ in spans)
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in range(4)), t
        assert r.base_sha256 == brute.spans_digest(spans), t
        held = [tuple(s.split(":")) for s in r.spans.split(",")] if r.spans else []
        names = ("email", "ip", "card", "phone")
        assert {(names[k], str(s), str(e)) for s, k, e in spans} <= set(held)
        assert len(held) == len(spans) + r.n_added
        assert held == sorted(held, key=lambda h: (int(h[1]), names.index(h[0])))


def test_personal_data_on_the_tables(spark):
    got = {r.doc_id: r for r in QUERIES["op10_pii"](spark, brute.SF).collect()}
    for i, t in brute.rows("documents", "doc_id, text"):
        assert got[i].base_sha256 == brute.spans_digest(brute.base_spans(t))


def test_personal_data_odd_rows(clashing, no_docs, docs_of):
    got = pii.find_personal_data(clashing).collect()
    assert len(got) == 14 and {r.base_sha256 for r in got if r.doc_id in (1, 2, 3)} == {EMPTY}
    assert pii.find_personal_data(no_docs).collect() == []
    long = "7" * 200_000 + " " + "x" * 200_000 + " me@site.org " + "a." * 50_000
    r = pii.find_personal_data(docs_of([(1, long)])).first()
    assert (r.n_email, r.n_card) == (1, 0)


def test_method_adds_spans_and_weighs_labelers(docs_of):
    texts = [f"phone: 555-{i:03}-{4000 + i} and tel 030 555 {1000 + i}" for i in range(20)] + SAMPLES
    got = pii.find_personal_data(docs_of(list(enumerate(texts)))).collect()
    assert sum(r.n_added for r in got) >= 20
    # A labeler that agrees with the others is trusted, one that contradicts them is not.
    agree = pii.Pattern(0, True, (1, 1, 0, 1), 500)
    against = pii.Pattern(0, False, (-1, -1, 0, -1), 500)
    mixed = pii.Pattern(0, False, (-1, 1, 0, -1), 20)
    post = pii.reliabilities([agree, against, mixed])
    assert post[agree] > 0.95 and post[against] < 0.05 and post[mixed] < 0.5


# -- sharding

def test_shards_on_the_tables(spark):
    got = QUERIES["op7_shard"](spark, brute.SF).collect()
    docs = dict(brute.rows("documents", "doc_id, text"))
    groups = Counter()
    slots, loads, home = defaultdict(list), Counter(), {}
    for r in got:
        t = docs[r.doc_id]
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (
            len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None)
        assert home.setdefault(t, r.shard) == r.shard
        groups[t] += r["size"]
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert len(got) == len(docs)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(loads.values()) == brute.lpt(list(groups.values()), 8)


def test_lpt_classes_equal_the_heap():
    rnd = random.Random(2)
    for _ in range(60):
        classes = Counter({rnd.randrange(1, 60): rnd.randrange(1, 90) for _ in range(rnd.randrange(1, 8))})
        classes[rnd.randrange(500, 3000)] = 1
        order = sorted(classes.items(), reverse=True)
        loads = [0] * 8
        for (size, n), took in zip(order, shard.lpt(order, 8), strict=True):
            assert sum(took) == n
            loads = [x + size * t for x, t in zip(loads, took, strict=True)]
        assert sorted(loads) == brute.lpt([s for s, n in order for _ in range(n)], 8)
    assert shard.lpt([(10**9, 1), (1, 10**9)], 2) == [[1, 0], [0, 10**9]]


def test_shards_odd_rows(clashing, no_docs, monkeypatch):
    monkeypatch.setattr(shard, "ROWS_PER_BUCKET", 2)
    got = shard.shard_documents(clashing, shards=3).collect()
    assert len(got) == 14
    by = defaultdict(list)
    slots = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        slots[r.shard].append(r.slot)
    assert by[1][0]["size"] == 1 and by[1][0].text_crc32 is None and by[2][0].text_crc32 == 0
    assert len({r.shard for r in by[7] + by[8]}) == 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard.shard_documents(no_docs).collect() == []


# -- packing

def tokens(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [[*t.encode(x or "", add_special_tokens=False).ids, 0] for x in texts]


def check_packing(rows, docs, capacity):
    want = Counter()
    for (i, _), ids in zip(docs, tokens([t for _, t in docs]), strict=True):
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], dtype="<u4")
            want[(i, k, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used), pack.lower_bound(np.array([r.length for r in rows]), capacity)


def test_packing_on_the_tables(spark):
    n, least = check_packing(QUERIES["op8_pack"](spark, brute.SF).collect(), brute.rows("documents", "doc_id, text"),
                             pack.CAPACITY)
    assert n <= least + 1


@pytest.mark.parametrize("per_partition", [100_000, 15])
def test_packing_exchanges_between_partitions(docs_of, per_partition):
    docs = [(i, "word " * (i * 7 % 61)) for i in range(200)]
    rows = pack.pack_documents(docs_of(docs), capacity=64, per_partition=per_partition).collect()
    n, least = check_packing(rows, docs, 64)
    # Partitions of 15 pieces alone need 110 sequences; two exchanges leave 3 more than the bound of 97.
    assert least <= n <= least + (0 if per_partition > 200 else 4)


def test_packing_exchanges_until_nothing_is_gained(docs_of):
    rnd = random.Random(604)
    docs = [(i, "word " * rnd.randrange(8, 45)) for i in range(600)]
    rows = pack.pack_documents(docs_of(docs), capacity=64, per_partition=4).collect()
    n, least = check_packing(rows, docs, 64)
    # Two exchanges leave 7 more than the bound of 260, six leave 2.
    assert least <= n <= least + 4


def test_packing_odd_rows(clashing, no_docs):
    docs = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    check_packing(pack.pack_documents(clashing).collect(), docs, pack.CAPACITY)
    assert pack.pack_documents(no_docs).collect() == []


def test_lower_bound_and_best_fit():
    assert pack.lower_bound(np.array([6, 6, 6]), 10) == 3
    assert pack.lower_bound(np.array([5, 5, 5, 5]), 10) == 2
    assert pack.lower_bound(np.array([], dtype=int), 10) == 0
    rnd = np.random.default_rng(1)
    for _ in range(50):
        x = rnd.integers(1, 65, rnd.integers(1, 80))
        where, offset, room = pack.best_fit_decreasing(x, 64)
        assert pack.lower_bound(x, 64) <= len(room)
        assert (64 - np.bincount(where, weights=x)).tolist() == room.tolist()


@pytest.mark.parametrize("text", [
    "a<|endoftext|>b <|ENDOFTEXT|>", "it's I'LL can't... 'S", "İstanbul ΑΣ Σ. é ́x \x85 a\xa0b \x1c z", "", " \n",
    "a" * 5000, "日本語 テスト 12,345.67", "\"foo\". (x), ... , é, …, ½. 'll. x'."])
def test_word_ids_equal_the_tokenizer(text):
    import public_tokenizers

    ids = pack.WordIds(public_tokenizers.path("word_bpe_49k.json")).encode(text.encode())
    assert np.frombuffer(ids, "<u4").tolist() == tokens([text])[0][:-1]


@pytest.mark.parametrize("mark", [",", ".", "!;", "%"])
def test_every_letter_before_a_mark(mark):
    """Letters that compose or lower-case to a letter and a combining mark included."""
    import public_tokenizers
    import unicodedata

    words = [w for c in map(chr, range(0x110000)) if unicodedata.category(c)[0] in "LN" and not "\u4e00" <= c <= "\ud7ff"
             and ord(c) < 0x17000 or 0xF900 <= ord(c) < 0xFB50 for w in (c + mark, "a" + c + mark, c + "a" + mark)]
    words += ["হয়, যায়।", "पहाड़,", "שׁשׁ.", "GAZİ.", "e\u0301, E\u0301.", "ſ, ı.", "ǅ.", "ß. ÷. ÿ, Ÿ."]
    w = pack.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    want = w.tokenizer.encode_batch_fast(words, add_special_tokens=False)
    wrong = [x for x, e in zip(words, want, strict=True) if np.frombuffer(w.encode(x.encode()), "<u4").tolist() != e.ids]
    assert len(words) > 20_000 and wrong == []


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers

    w = pack.WordIds(public_tokenizers.path("byte_bpe_50k.json"))
    text = "Two  words, and\nCAPITALS <|endoftext|> 12"
    assert not w.by_word and w.tokenizer.decode(np.frombuffer(w.encode(text.encode()), "<u4").tolist(), skip_special_tokens=False) == text
    assert pack.WordIds(public_tokenizers.path("word_bpe_49k.json")).by_word


# -- language
def test_a_small_share_of_a_long_text_is_found():
    """Half a percent of 8,000 words is 40 words: enough evidence, whatever the share."""
    rnd = random.Random(5)
    words = {k: ["".join(rnd.choice(letters) for _ in range(5)) for _ in range(200)]
             for k, letters in (("aa", "abcdefg"), ("bb", "hijklmn"), ("cc", "opqrstu"))}
    model = language.Languages({k: np.bincount(language.trigrams(" ".join(w)), minlength=1 << language.BITS) * 5000.0
                                for k, w in words.items()})
    text = " ".join([rnd.choice(words["aa"]) for _ in range(7960)] + [rnd.choice(words["bb"]) for _ in range(40)])
    got = model.mixture(text)
    assert [k for k, _ in got] == ["aa", "bb"] and 0.003 < got[1][1] < 0.008
    assert [k for k, _ in model.mixture(" ".join(words["aa"]))] == ["aa"]



def test_language_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op5_language"](spark, "/root/testdata/sf0.01").collect()}
    right = [got[i].lang_pred == lang for i, lang in brute.rows("documents", "doc_id, lang", "/root/testdata/sf0.01")
             if brute.held_out(i)]
    assert np.mean(right) >= 0.98
    assert all(r.held_out == brute.held_out(i) and 0 <= r.score <= 1 for i, r in got.items())


def test_mixture_shares():
    one, two = "the water of the town and the hill ", "wasser und der berg über dem fluss "
    counts = {k: np.bincount(language.trigrams(t * 200), minlength=1 << language.BITS).astype(float)
              for k, t in (("en", one), ("de", two))}
    model = language.Languages(counts)
    assert [k for k, _ in model.mixture(one * 20)] == ["en"]
    both = dict(model.mixture(one * 30 + two * 10))
    assert set(both) == {"en", "de"} and 0.65 < both["en"] < 0.85
    assert model.mixture("123 ...") == [] and model.mixture(None) == []


def test_language_odd_rows(clashing, no_docs):
    got = language.predict_languages(clashing).collect()
    assert len(got) == 14
    for r in got:
        if r.doc_id in (1, 2, 3, 10):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert (r.lang_pred, r.score) == ("en", 1.0)
        assert r.doc_id is not None or r.held_out
    assert language.predict_languages(no_docs).collect() == []
    kept = language.keep_identified(clashing, clashing, 0.5)
    assert kept.columns == clashing.columns and kept.count() == 10
    assert {r.lang_pred for r in language.identify(clashing, no_docs, ["doc_id"]).collect()} == {"und"}


# -- quality and toxicity
def test_letters_that_only_a_caseless_search_matches(docs_of, labels_of):
    """U+017F, U+0131 and U+0130 in and around identity terms, in labelled texts."""
    texts = ["The Chri\u017ftian faith.", "an \u0131ndian man", "\u0130NDIAN women. ASIAN \u0130 men", "MUSL\u0130M", "Gay men and A\u017fian women!"]
    docs = docs_of([(i, texts[i % 5] + f" {i}") for i in range(60)])
    rows = toxicity.score_toxicity(docs, labels_of([(i, None, i % 2) for i in range(60)])).collect()
    assert len(rows) == 60 and all(0 <= r.score <= 1 for r in rows)
    for t in texts:
        before, after = toxicity.counterfactuals(t)
        assert before != after and before == before.lower()
    assert toxicity.counterfactuals(texts[2])[0] == "asian i\u0307 men"



def area(score, y):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    n = y.sum()
    return (order[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize("name, label, least", [("op1_quality", 1, 0.95), ("op2_toxicity", 2, 0.75)])
def test_held_out_scores(spark, name, label, least):
    got = {r.doc_id: r for r in QUERIES[name](spark, "/root/testdata/sf0.01").collect()}
    rows = [r for r in brute.rows("labels", "doc_id, quality, toxic", "/root/testdata/sf0.01") if brute.held_out(r[0])]
    y = np.array([r[label] for r in rows])
    assert area(np.array([got[r[0]].score for r in rows]), y) >= least
    assert all(r.held_out == brute.held_out(i) and 0 <= r.score <= 1 for i, r in got.items())


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_scores_odd_rows(clashing, no_docs, labels_of, score):
    labels = labels_of([(4, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (8, 1, 0), (8, 0, 1), (9, 1, 0), (77, 1, 1)])
    got = score(clashing, labels).collect()
    assert len(got) == 14 and all(0 <= r.score <= 1 for r in got)
    assert score(no_docs, labels).collect() == []
    assert {r.score for r in score(clashing, labels.limit(0)).collect()} == {0.5}


def test_mentions_do_not_move_the_score():
    """A group named in toxic examples only is not held against neutral mentions."""
    rnd = random.Random(4)
    words = [f"{a}{b}" for a in ("ta", "ri", "mo", "ke") for b in ("lan", "sor", "pin", "dul", "gam")]
    texts, y = [], []
    for i in range(400):
        w = [rnd.choice(words) for _ in range(12)]
        bad = i % 4 == 0
        if bad:
            w[3:3] = ["vilescum"] if rnd.random() < 0.8 else []
            w[6:6] = ["muslim"] if rnd.random() < 0.9 else []
        texts.append(" ".join(w) + ".")
        y.append(int(bad))
    pairs = [toxicity.counterfactuals(t) for t in texts]
    kept = np.unique(np.concatenate([toxicity.grams(t) for t in (*texts, *(p[1] for p in pairs))]))
    place = toxicity._places(kept)
    own, before, after = ([np.unique(place[toxicity.grams(t)]) for t in ts]
                          for ts in (texts, [p[0] for p in pairs], [p[1] for p in pairs]))
    neutral, bad = "the muslim talan risor mopin kedul", "the vilescum talan risor mopin kedul"
    gap = {}
    for fairness in (0.0, toxicity.FAIRNESS):
        fitted = toxicity.fit_weights(own, before, after, np.array(y, dtype=float), len(kept), fairness=fairness)
        c = toxicity.Classifier(kept, *fitted)
        gap[fairness] = c.score(neutral)
        assert c.score(bad) > 0.5
    assert gap[toxicity.FAIRNESS] < 0.5 * gap[0.0] and gap[toxicity.FAIRNESS] < 0.5


def test_word_ids_after_words_are_forgotten(monkeypatch):
    """With room for few words they move between the generations and go; the ids stay right."""
    import public_tokenizers

    monkeypatch.setattr(pack, "REMEMBERED", 40)
    w = pack.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = [t for _, t in brute.rows("documents", "doc_id, text") if t] * 2
    want = w.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert all(np.frombuffer(w.encode(t.encode()), "<u4").tolist() == e.ids for t, e in zip(texts, want, strict=True))
    assert w.older
