"""Text operators against the libraries or brute force, and their edge cases."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import tokenizers

from tidemark.llm import bpe, langid, omh, packing, substring, toxicity, training_order
from tidemark.llm.words import Words

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PLAIN = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " ", "a", "It's 12 they'll  ...   !!", "x \n y   \n\n z ", "漢字🙂 é́   \x85 b", "<|endoftext|> tail", "a" * 3000, " " * 2500, "ab " * 9000, "a", "a"]


def table(spark, texts, **more):
    rows = [(i, t, *[m[i] for m in more.values()]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string" + "".join(f", {c} string" for c in more))


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    tik = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    tok = tokenizers.Tokenizer.from_file(PLAIN)
    tok.encode_special_tokens = True
    return tik.encode_ordinary, lambda t: tok.encode(t, add_special_tokens=False).ids


def test_encoder_matches_both_libraries(reference):
    rng = random.Random(1)
    alphabet = " \n\t\r\x1c\x85\xa0　abcXYZ'sé٣ß1234!?.,-漢字🙂​́  '"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(1500)] + [t or "" for t in ODD]
    for path, want in zip((MULTI, PLAIN), reference, strict=True):
        got = bpe.Encoder(path, PATTERN).encode(texts)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [list(want(t)) for t in texts]


def test_encoder_with_a_full_table(reference, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 3)
    enc = bpe.Encoder(MULTI, PATTERN)
    for texts in (["one two three four"], ["five one six", "two two seven"]):
        assert [np.frombuffer(g, "<u4").tolist() for g in enc.encode(texts)] == [reference[0](t) for t in texts]


def test_encode_and_decode_round_trip(spark):
    df = table(spark, ODD, token_ids=["x"] * len(ODD), lang=[None] * len(ODD))
    coded = bpe.encode(df, MULTI, PATTERN)
    assert coded.columns == ["doc_id", "text", "lang", "token_ids"]
    rows = {r.doc_id: r for r in bpe.decode(coded, MULTI).collect()}
    assert [bytes(rows[i].decoded).decode() for i in range(len(ODD))] == [t or "" for t in ODD]
    assert bpe.digests(df.limit(0), MULTI, PATTERN).count() == 0
    assert {r.n_tokens for r in bpe.digests(df.where("text IS NULL"), MULTI, PATTERN).collect()} == {0}


def brute_repeats(texts, length):
    count = collections.Counter()
    words = [WORD.findall(t or "") for t in texts]
    for w in words:
        count.update(tuple(w[i : i + length]) for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if count[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("length", [1, 2, 3, 8, 35])
def test_repeated_windows_match_brute_force(spark, length):
    rng = random.Random(length)
    passages = [[f"p{rng.randint(0, 30)}" for _ in range(rng.randint(length, 3 * length + 3))] for _ in range(5)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += rng.choice(passages) if rng.random() < 0.5 else [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(0, 40))]
        at = rng.randint(0, max(0, len(parts) - 1))
        texts.append(" ".join(parts[at:]) if rng.random() < 0.3 else "\t".join(parts))
    texts += [texts[0], texts[1], None, "", "  \n ", "a a " * 40, "z " * 300, " x \x85y"]
    df = table(spark, texts, n_words=["old"] * len(texts), lang=[None] * len(texts)).repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring.remove_repeats(df, length).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts, length)


def test_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "q r s")], "doc_id long, text string")
    got = sorted((r.n_words, r.n_removed) for r in substring.remove_repeats(df, 3).collect())
    assert got == [(3, 0), (5, 5), (5, 5)]
    assert substring.remove_repeats(df.limit(0), 3).count() == 0


def test_word_hashes_follow_words_only():
    w = Words([b"one two one", None, b" two\x0bone ", "é".encode()])
    assert [w.word(i) for i in range(len(w))] == [b"one", b"two", b"one", b"two", b"one", "é".encode()]
    assert w.hash[0] == w.hash[2] == w.hash[4] and w.hash[1] == w.hash[3] and w.first.tolist() == [0, 3, 3, 5, 6]
    assert w.spans(np.array([1]), 2) == w.spans(np.array([3]), 2)


def test_packing_keeps_every_id_once(spark, reference):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(rng.choice([0, 1, 30, 200, 900]))) for _ in range(150)] + ODD
    df = table(spark, texts, offset=["x"] * len(texts), lang=[None] * len(texts)).repartition(3)
    rows = packing.pack(df, PLAIN, PATTERN, ids="ids").collect()
    docs, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.length * 4 == len(r.ids)
    for i, t in enumerate(texts):
        parts = sorted(docs[i], key=lambda r: r.start)
        flat = np.frombuffer(b"".join(bytes(p.ids) for p in parts), "<u4").tolist()
        assert flat == [*reference[1](t or ""), 0]
        assert [p.start for p in parts] == np.cumsum([0, *[p.length for p in parts[:-1]]]).tolist() and {p.doc_tokens for p in parts} == {len(flat)}
    filled = padded = 0
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        total = sum(r.length for r in s)
        assert [r.offset for r in s] == np.cumsum([0, *[r.length for r in s[:-1]]]).tolist() and total <= 1024
        assert {r.padded_to for r in s} == {total if total & (total - 1) == 0 else 1024}
        filled, padded = filled + total, padded + s[0].padded_to
    assert filled / padded > 0.93  # three partitions of few documents; 0.99 at scale
    assert packing.pack(df.limit(0), PLAIN, PATTERN).count() == 0


def test_differencing_gives_near_equal_windows():
    rng = random.Random(5)
    sizes = [rng.randint(1, 256) for _ in range(400)]
    bins = packing.difference(sizes, 50)
    assert sorted(i for _, b in bins for i in b) == list(range(400)) and all(s == sum(sizes[i] for i in b) for s, b in bins)
    assert max(s for s, _ in bins) - min(s for s, _ in bins) <= 10
    assert packing.pack_block([], 8) == [] and sorted(map(len, packing.pack_block([8, 8, 1], 8))) == [1, 1, 1]


@pytest.mark.parametrize("size", [1, 2, 3, 1000, 4096, 70001])
def test_feistel_is_a_permutation(size):
    a, b = (training_order.feistel(np.arange(size), size, key) for key in (1, 2))
    assert sorted(a.tolist()) == list(range(size)) and (size < 100 or (a != b).any())


def test_training_order_round_trip(spark, tmp_path, reference):
    texts = [f"document {i} " * (i % 37) for i in range(120)] + ODD
    df = table(spark, texts).coalesce(2)
    out = str(tmp_path / "shards")
    manifest = training_order.write(df, out, PLAIN, PATTERN, tokens=64, shards=3)
    rows = sorted(training_order.slots(spark, out, manifest, 64).collect())
    assert [r.slot for r in rows] == list(range(len(rows))) and all(r.intact for r in rows) and len({r.shard for r in rows}) == 3
    read = training_order.read_slots(out, 0, len(rows))
    assert [x.tolist() for x in training_order.read_slots(out, 7, 5)] == [x.tolist() for x in read[7:12]]
    order = sorted(range(len(rows)), key=lambda i: rows[i].number)
    assert order != list(range(len(rows)))
    flat = np.concatenate([read[i] for i in order]).tolist()
    assert sorted(flat) == sorted(x for t in texts for x in [*reference[1](t or ""), 0])
    again = str(tmp_path / "again")
    training_order.write(df, again, PLAIN, PATTERN, tokens=64, shards=3)
    for s in range(3):
        assert (tmp_path / f"shards/shard-{s:06d}.bin").read_bytes() == (tmp_path / f"again/shard-{s:06d}.bin").read_bytes()
    assert training_order.write(df.limit(0), str(tmp_path / "none"), PLAIN, PATTERN).count() == 0


def test_language_of_whole_texts(spark):
    rng = random.Random(2)
    stems = {"aa": ["kar", "tok", "mil", "rin"], "bb": ["shu", "wep", "zog", "fly"]}
    word = lambda k: "".join(rng.choice(stems[k]) for _ in range(rng.randint(1, 3)))
    text = lambda k, n: " ".join(word(k) for _ in range(n))
    rows = [(i, text("aa" if i % 2 else "bb", 40), "aa" if i % 2 else "bb") for i in range(60)] + [(99, None, "aa"), (98, "x", None)]
    m = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert m.labels == ["aa", "bb"]
    new = [text("aa", 30), text("bb", 1), text("aa", 60) + ". " + text("bb", 25), None, "", "123 --- 4!", text("bb", 20000)]
    got = {r.doc_id: r for r in langid.predict(table(spark, new, score=["x"] * 7, other=[None] * 7), m, spans="runs").collect()}
    assert [got[i].lang_pred for i in range(7)] == ["aa", "bb", "aa", "und", "und", "und", "bb"]
    assert all(0 <= got[i].score <= 1 for i in range(7)) and got[2].score < 0.9 < got[0].score
    runs = [(r.lang, r.words) for r in got[2].runs]
    assert runs[0][0] == "aa" and runs[-1][0] == "bb" and abs(sum(n for k, n in runs if k == "aa") - 60) <= 3
    none = langid.fit(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in langid.predict(table(spark, ["a", None]), none).collect()} == {"und"}
    assert langid.predict(table(spark, ["a"]).limit(0), m).count() == 0


def test_copies_do_not_lower_the_share_of_training_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "train", lambda texts, langs: seen.append((texts, langs)))
    rows = [(f"a{i} word", "aa") for i in range(400)] + [("b copy", "bb")] * 20000 + [(f"b{i} word", "bb") for i in range(399)]
    langid.fit(spark.createDataFrame(rows, "text string, lang string"), texts=100)
    (texts, langs), = seen
    assert len(set(texts)) == len(texts) and all(70 <= langs.count(k) <= 130 for k in ("aa", "bb"))


def test_language_of_texts_without_spaces(spark):
    rng = random.Random(6)
    stems = {"aa": ["kar", "tok", "mil", "rin"], "bb": ["shu", "wep", "zog", "fly"], "cc": ["漢字", "情報", "東京"], "dd": ["กข", "คง", "จฉ"]}
    text = lambda k, n, gap: gap.join("".join(rng.choice(stems[k]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    rows = [(text(k, 40, "" if k in ("cc", "dd") else " "), k) for k in stems for _ in range(60)]
    m = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    new = ["kartokmilrinkartokmilrinkar" + text("bb", 400, ""), text("cc", 4, "") + text("dd", 400, ""), text("aa", 5, "\u00a0") + "\u3000" + text("bb", 400, "\u00a0"), text("aa", 9, " ")]
    got = {r.doc_id: r for r in langid.predict(table(spark, new), m, spans="runs").collect()}
    assert [got[i].lang_pred for i in range(4)] == ["bb", "dd", "bb", "aa"]
    assert [[r.lang for r in got[i].runs] for i in range(2)] == [["aa", "bb"], ["cc", "dd"]]
    assert {(r.first, r.words) for i in range(3) for r in got[i].runs} == {(0, 1)} and [(r.first, r.words) for r in got[3].runs] == [(0, 9)]
    w, place = langid.tokens(["x " + "é" * 100 + " y", None, "z" * 47, "z" * 48])
    assert [w.word(i) for i in range(len(w)) if place[i] == 1] == ["é".encode() * 16] * 5 + ["é".encode() * 20] and place[-3:].tolist() == [0, 0, 0]


def test_forward_backward_equals_enumeration():
    import itertools

    rng = np.random.default_rng(4)
    m = langid.Model(["a", "b", "c"], None, rng.normal(size=(3, 3)), rng.normal(size=3))
    score = rng.normal(size=(9, 3))
    start, size = np.array([0, 4, 5]), np.array([4, 1, 4])
    got, moves, firsts = langid.forward_backward(score, start, size, m, pairs=True)
    want, pair, first = np.zeros((9, 3)), np.zeros((3, 3)), np.zeros(3)
    for s, n in zip(start, size, strict=True):
        paths = list(itertools.product(range(3), repeat=int(n)))
        p = np.array([np.exp(m.first[y[0]] + sum(score[s + t, y[t]] for t in range(n)) + sum(m.transition[y[t], y[t + 1]] for t in range(n - 1))) for y in paths])
        for y, w in zip(paths, p / p.sum(), strict=True):
            first[y[0]] += w
            for t in range(n):
                want[s + t, y[t]] += w
                if t:
                    pair[y[t - 1], y[t]] += w
    assert np.allclose(got, want) and np.allclose(moves, pair) and np.allclose(firsts, first)


def test_factorization_machine_learns_a_pair(spark):
    rng = random.Random(9)
    rows = []
    for i in range(1200):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.choice('abcdefgh')}{rng.choice('ijklmn')}" for _ in range(12)] + ["Insult!"] * insult + ["group"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(insult and group)))
    m = toxicity.fit(spark.createDataFrame([*rows, (5000, None, 0), (5001, "x", None)], "doc_id long, text string, toxic int"), penalty=1e-5)
    new = ["insult group", "GROUP: insult.", "insult", "group", "wai wbj", None, "", "wai " * 30000 + "insult group"]
    got = {r.doc_id: r.score for r in toxicity.score(table(spark, new, score=["x"] * 8, y=[None] * 8), m).collect()}
    assert [got[i] >= 0.5 for i in range(8)] == [True, True, False, False, False, False, False, True]
    assert all(0 <= x <= 1 for x in got.values())
    one = toxicity.fit(spark.createDataFrame([("a b", 1), ("c", 1)], "text string, toxic int"))
    none = toxicity.fit(spark.createDataFrame([], "text string, toxic int"))
    assert toxicity.score(table(spark, ["a"]), one).first().score > 0.5 and toxicity.score(table(spark, ["a"]), none).first().score == 0.5
    assert toxicity.score(table(spark, ["a"]).limit(0), m).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, words, share):
    out = list(words)
    for _ in range(int(share * len(words))):
        i, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.5:
            out[i] = f"n{rng.randint(0, 10**6)}"
        elif kind < 0.75:
            out.insert(i, f"n{rng.randint(0, 10**6)}")
        else:
            del out[i]
    return out


def test_alignment_equals_edit_distance():
    rng = random.Random(6)
    a, b = [], []
    for _ in range(200):
        x = [rng.randint(0, 40) for _ in range(rng.randint(1, 150))]
        y = [z if isinstance(z, int) else 1000 + int(z[1:]) for z in changed(rng, x, rng.random() * 0.35)] or [7]
        a.append(np.array(x)), b.append(np.array(y))
    a, b = [*a, np.array([1]), np.array([], int)], [*b, np.arange(50), np.array([], int)]
    want = [max(len(x), len(y)) > 0 and 1 - edits(x, y) / max(len(x), len(y)) >= 0.8 - 1e-9 for x, y in zip(a, b, strict=True)]
    assert omh.similar(a, b, 0.8).tolist() == want and 0.3 < np.mean(want) < 0.9


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(8)
    common = [f"c{i}" for i in range(40)]
    texts = []
    for f in range(12):
        base = [f"b{f}x{rng.randint(0, 10**6)}" for _ in range(rng.randint(20, 160))]
        if f % 3 == 0:
            base[5:5] = common
        texts += [base] + [changed(rng, base, rng.choice([0.0, 0.02, 0.05, 0.1])) for _ in range(rng.randint(0, 6))]
    texts += [["one", "two"], ["one", "two"], ["one", "two", "three"]]
    words = list(texts)
    texts = [" ".join(t) for t in texts] + [None, "", " \n", None]
    words += [[], [], [], []]
    near = np.array([[i == j or (bool(a) and bool(b) and 1 - edits(a, b) / max(len(a), len(b)) >= 0.8) for j, b in enumerate(words)] for i, a in enumerate(words)])
    root = list(range(len(words)))
    for _ in words:
        root = [min(root[j] for j in np.flatnonzero(near[i])) for i in range(len(words))]
    df = table(spark, texts, kept=["x"] * len(texts), component_id=[None] * len(texts)).repartition(3)
    got = {r.doc_id: r for r in omh.near_duplicates(df).collect()}
    assert [got[i].component_id for i in range(len(texts))] == root
    assert [got[i].kept for i in range(len(texts))] == [i == r for i, r in enumerate(root)]
    first = {}
    assert [got[i].class_id for i in range(len(texts))] == [first.setdefault(t, i) if w else i for i, (t, w) in enumerate(zip(texts, words, strict=True))]
    assert omh.near_duplicates(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.kept) for r in omh.near_duplicates(odd).collect()) == [("3", True), ("3", True), ("None", True)]


def bucket_components(texts, least=0.8):
    """Components over all pairs that agree in a sketch, and the number of links."""
    n = len(texts)
    keys = omh.sketch([t.encode() for t in texts])
    met = np.zeros((n, n), bool)
    for k in keys.T:
        met |= k[:, None] == k
    numbers = {}
    words = [np.array([numbers.setdefault(w, len(numbers)) for w in t.split()]) for t in texts]
    has = np.zeros((n, len(numbers)), np.float32)
    for i, w in enumerate(words):
        has[i, w] = 1  # words of these texts are distinct
    a, b = np.nonzero(np.triu(met & (has @ has.T >= least * len(words[0])), 1))
    ok = omh.similar([words[i] for i in a], [words[j] for j in b], least)
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a[ok], root[b[ok]])
        np.minimum.at(low, b[ok], root[a[ok]])
        if (low == root).all():
            return root.tolist(), int(ok.sum())
        root = low


@pytest.mark.parametrize("tile,first", [(512, 8), (64, 1)])
def test_a_text_that_links_its_edited_copies(spark, monkeypatch, tile, first):
    monkeypatch.setattr(omh, "TILE", tile)
    monkeypatch.setattr(omh, "FIRST_PAIRS", first)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base)]
    for c in range(1000):  # 0.88 to the base, 0.76 and little more to each other
        at = set(rng.sample(range(200), 24))
        texts.append(" ".join(f"x{c}y{i}" if i in at else w for i, w in enumerate(base)))
    want, _ = bucket_components(texts)
    got = {r.doc_id: r.component_id for r in omh.near_duplicates(table(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want and len(set(want)) < 50


def test_near_pairs_among_texts_with_a_long_shared_passage(spark):
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(150)]
    texts = []
    for c in range(500):
        own = [f"o{c}x{i}" for i in range(50)]
        at = set(rng.sample(range(50), 20))
        texts += [" ".join(passage + own), " ".join(passage + [f"e{w}" if i in at else w for i, w in enumerate(own)])]
    want, links = bucket_components(texts)
    got = {r.doc_id: r.component_id for r in omh.near_duplicates(table(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want and links > 490


def test_texts_that_meet_in_many_buckets_are_dealt_a_few_times(spark, monkeypatch):
    made = []

    def counted(df, name, cut=omh.cut):
        out = cut(df, name)
        made.append((name, out.count()))
        return out

    monkeypatch.setattr(omh, "cut", counted)
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for c in range(200):
        own = [f"o{c}x{i}" for i in range(60)]
        at = set(rng.sample(range(60), 20))
        texts += [" ".join(passage + own), " ".join(passage + [f"e{w}" if i in at else w for i, w in enumerate(own)])]
    want, links = bucket_components(texts)
    got = {r.doc_id: r.component_id for r in omh.near_duplicates(table(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want and links > 180
    assert max(n for name, n in made if name == "omh-members") > 5 * len(texts)  # they meet often
    assert max(n for name, n in made if name in ("omh-open", "omh-found")) < 3 * len(texts)


def test_packets_hold_the_pairs_of_a_tile_that_met():
    r = np.random.default_rng(5)
    n, base = 150, r.integers(0, 5000, 100)
    rows = [np.where(r.random(100) < 0.05, r.integers(0, 5000, 100), base) for _ in range(n)]
    own = [r.choice(6, 2, replace=False).tolist() for _ in range(n)]
    t = pa.table({"bucket": np.full(n, 7), "id": np.arange(n) * 3, "comp": np.arange(n), "left": np.arange(n) % 2 == 0, "other": np.ones(n, bool),
                  "own": own, "words": pa.array([x.astype("<i4").tobytes() for x in rows], pa.binary())})
    got = []
    for p in omh._packets(t, 0.8, 10**6):
        p = p.to_pylist()[0]
        assert len(p["ids"]) <= 2 * omh.BLOCK and [rows[i // 3].astype("<i4").tobytes() for i in p["ids"]] == p["words"]
        got += [(p["ids"][i] // 3, p["ids"][j] // 3) for i, j in zip(p["x"], p["y"], strict=True)]
    left, right = range(0, n, 2), range(1, n, 2)
    assert sorted(got) == [(i, j) for i in left for j in right if i < j and set(own[i]) & set(own[j])]
    assert list(omh._packets(t.slice(0, 1), 0.8, 8)) == []


@pytest.mark.parametrize("low,high", [(0.80, 0.85), (0.85, 0.90), (0.90, 1.0)])
def test_share_of_similar_pairs_that_meet_in_a_sketch(low, high):
    """Words changed at random places, as many as the similarities of the band take."""
    rng = random.Random(int(low * 100))
    met = []
    for p in range(300):
        base = [f"t{p}w{i}" for i in range(200)]
        at = set(rng.sample(range(200), rng.randint(round(200 * (1 - high)) + 1, round(200 * (1 - low)))))
        keys = omh.sketch([" ".join(base).encode(), " ".join(f"x{i}" if i in at else w for i, w in enumerate(base)).encode()])
        met.append((keys[0] == keys[1]).any())
    assert np.mean(met) >= 0.9


def test_large_buckets_are_divided_by_rare_words(spark, monkeypatch):
    """Texts that share a passage, in one bucket, some of them near each other:
    with every bucket divided, components are those of all pairs."""
    monkeypatch.setattr(omh, "LARGE", 3)
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(120)]
    texts = []
    for c in range(60):
        own = [f"o{c}x{i % 25}" for i in range(50)]
        at = set(rng.sample(range(50), 22))
        texts += [passage + own, passage + [f"e{c}y{i}" if i in at else w for i, w in enumerate(own)]]
    near = np.array([[1 - edits(a, b) / max(len(a), len(b)) >= 0.8 for b in texts] for a in texts])
    root = list(range(len(texts)))
    for _ in texts:
        root = [min(root[j] for j in np.flatnonzero(near[i])) for i in range(len(texts))]
    got = {r.doc_id: r.component_id for r in omh.near_duplicates(table(spark, [" ".join(t) for t in texts])).collect()}
    assert [got[i] for i in range(len(texts))] == root and 30 < len(set(root)) < 70


def test_digests_are_hex(spark):
    r = bpe.digests(table(spark, ["hello"]), MULTI, PATTERN).first()
    assert r.decoded_sha256 == hashlib.sha256(b"hello").hexdigest()


def test_thousands_of_equal_rows_lose_their_windows(spark):
    rng = random.Random(21)
    text = " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(300))
    words = text.split()
    other = " ".join(["own", "words", *words[100:140], "behind"])
    alone = " ".join(f"z{i}" for i in range(60))
    rows = [(None, text)] * 3000 + [(None, "short text")] * 50 + [(1, other), (2, alone), (3, None), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = substring.remove_repeats(df, 35).groupBy("doc_id", "text", "n_words", "n_removed").count().collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, "", 300, 300, 3000), (None, "short text", 2, 0, 50), (1, "own words behind", 43, 40, 1),
                                                       (2, alone, 60, 0, 1), (3, "", 0, 0, 2)], key=str)


def test_a_tile_of_near_copies_takes_little_memory():
    import tracemalloc

    r = np.random.default_rng(3)
    base, n = r.integers(0, 5000, 200), 2048
    rows = []
    for _ in range(n):
        row = base.copy()
        row[r.integers(0, 200, 60)] = r.integers(0, 5000, 60)
        rows.append(row)
    left, comp = np.arange(n) < n // 2, r.integers(0, n // 3, n)
    t = pa.table({"bucket": np.full(n, 7), "id": np.arange(n), "comp": comp, "left": left, "other": np.ones(n, bool), "words": pa.array([x.astype("<i4").tobytes() for x in rows], pa.binary())})
    tracemalloc.start()
    found = omh._tile(t, 0.8, 10**6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20
    few = dict(zip(range(n), rows, strict=True))
    pairs = set(zip(found["a"].to_pylist(), found["b"].to_pylist(), strict=True))
    for a in range(20):
        for b in range(n // 2, n // 2 + 20):
            near = omh.similar([few[a]], [few[b]], 0.8)[0] and comp[a] != comp[b]
            assert not near or (a, b) in pairs
