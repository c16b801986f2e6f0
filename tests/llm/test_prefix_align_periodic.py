"""Operators 11 to 13 against the libraries, plain loops and brute force."""

import collections
import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from tests.llm.test_text_operators import ODD, table
from tidemark.llm import alignment, bpe, periodic, prefix_bpe, queries

PLAIN = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"
MORE = [*ODD, "<s> </s> <unk> <|endoftext|><|endoftext|>", "<0x41> a▁b", "▁", "\x00 nul", "aaaa" * 30, "é é", "\n\n\n", "a", None, "naïve 漢字かな交じり文"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def texts_of(spark, name="documents"):
    return spark.read.parquet(f"{SF}/{name}.parquet").select("doc_id", "text")


# ---- 11: prefixes -------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PLAIN)


def test_prefix_encoder_matches_library(library):
    rng = random.Random(3)
    sets = [" \n\t\r\x1c\x85\xa0abcXYZ'se1234!?.,-漢字🙂é", "ab", "a", "a ", "hello wrldin", "0123456789", "=-_"]
    enc = prefix_bpe.PrefixEncoder(PLAIN, PATTERN)
    for k in range(3000):
        chars = rng.choice(sets)
        text = "".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) + ("<|endoftext|> x" if k % 40 == 0 else "")
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    for text in ("a" * 100_000, "ab" * 50_000, "".join(rng.choice("abcdefgh") for _ in range(100_000))):
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_prefix_encoder_ordinary_special_strings():
    plain = tokenizers.Tokenizer.from_file(PLAIN)
    plain.encode_special_tokens = True
    enc = prefix_bpe.PrefixEncoder(PLAIN, PATTERN, special=False)
    text = "x<|endoftext|>y"
    assert np.frombuffer(enc.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_prefix_encoder_forgets_safely(library, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "KEPT_PIECES", 2)
    monkeypatch.setattr(prefix_bpe, "KEPT_PAIRS", 3)
    enc = prefix_bpe.PrefixEncoder(PLAIN, PATTERN)
    for text in ("one two three four", "unquestionably reverberating one two"):
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_pair_test_against_merging_both(library):
    """``apart`` is what merging the two tokens' bytes from scratch says."""
    enc = prefix_bpe.PrefixEncoder(PLAIN, PATTERN)
    ranks = enc.merge

    def merged(raw):
        ids = [next(i for i in (enc.tokens.index(bytes([b])),)) for b in raw]
        while True:
            best = min(((ranks[a * enc.size + b], k) for k, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if a * enc.size + b in ranks), default=None)
            if best is None:
                return ids
            whole = enc.tokens.index(enc.tokens[ids[best[1]]] + enc.tokens[ids[best[1] + 1]])
            ids[best[1]:best[1] + 2] = [whole]

    rng = random.Random(5)
    short = [i for i in range(256, 3000) if enc.tokens[i].isalpha()]
    for _ in range(150):
        a, b = rng.choice(short), rng.choice(short)
        assert enc.apart(a, b) == (merged(enc.tokens[a] + enc.tokens[b]) == [a, b])


def test_suffix_automaton_finds_every_ending():
    rng = random.Random(7)
    strings = {s: i for i, s in enumerate({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))) for _ in range(60)} | {b"a", b"b", b"c"})}
    auto = prefix_bpe.SuffixAutomaton(strings)
    for _ in range(50):
        text, state, matched = bytes(rng.choice(b"abc") for _ in range(40)), 0, 0
        for end, c in enumerate(text, 1):
            while c not in auto.next[state]:
                state = auto.link[state]
                matched = auto.length[state]
            state, matched = auto.next[state][c], matched + 1
            at, got = state if matched == auto.length[state] and auto.string[state] >= 0 else auto.up[state], []
            while at >= 0 and auto.string[at] >= 0:
                got.append(auto.string[at])
                at = auto.up[at]
            want = [i for s, i in strings.items() if text[:end].endswith(s)]
            assert sorted(got) == sorted(want) and len(got) == len(set(got))


def test_merge_list_out_of_order_is_an_error(tmp_path):
    spec = json.load(open(PLAIN))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    (tmp_path / "bad.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="merge"):
        prefix_bpe.PrefixEncoder(str(tmp_path / "bad.json"), PATTERN)


def test_prefix_columns_and_edges(spark, library):
    df = table(spark, MORE, token_ids=["x"] * len(MORE), lang=[None] * len(MORE))
    done = prefix_bpe.round_trip(df, PLAIN, PATTERN)
    assert done.columns == ["doc_id", "text", "lang", "token_ids", "decoded"]
    for r in done.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == want and r.decoded == (r.text or "")
    again = prefix_bpe.decode(prefix_bpe.encode(df, PLAIN, PATTERN), PLAIN, PATTERN)
    assert {r.doc_id: r.decoded for r in again.collect()} == {i: t or "" for i, t in enumerate(MORE)}
    assert prefix_bpe.digests(df.where("false"), PLAIN, PATTERN).collect() == []
    broken = spark.createDataFrame([(1, [162, 162, 0]), (2, None)], "k long, token_ids array<int>")
    assert {r.k: r.decoded for r in prefix_bpe.decode(broken, PLAIN, PATTERN).collect()} == {1: library.decode([162, 162, 0], skip_special_tokens=False), 2: ""}


def test_op11_equals_library(spark, library):
    got = {r.doc_id: r for r in queries.op11_prefix_bpe(spark, SF).collect()}
    for r in texts_of(spark).collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        g = got.pop(r.doc_id)
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert not got


# ---- 12: alignment ------------------------------------------------------

def aligned_by_loops(texts):
    """Token spans by plain loops; all overlaps by comparing every pair nearby."""
    a = tokenizers.Tokenizer.from_file(PLAIN)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    to_byte = bpe._printable_bytes()

    def spans(ids, raws):
        at, out = 0, []
        for i, raw in zip(ids, raws, strict=True):
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    rows = []
    for text in texts:
        ids = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        two = b.encode(text) if text else []
        raw_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids]
        raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in two for p in [b.id_to_piece(i)]]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            rows.append(([], [], ""))
            continue
        sa, sb = spans(ids, raw_a), spans(two, raw_b)
        links, j = [], 0
        for i, x, y in sa:
            while j and sb[j][1] > x:
                j -= 1
            k = j
            while k < len(sb) and sb[k][1] < y:
                if sb[k][2] > x:
                    links.append((i, sb[k][0]))
                j = k
                k += 1
        ends = sorted({y for *_, y in sa} & {y for *_, y in sb})
        groups = []
        for lo, hi in zip([0, *ends], ends, strict=False):
            groups.append(tuple(",".join(str(i) for i, x, y in s if lo <= x and y <= hi) for s in (sa, sb)))
        rows.append((groups, links, (len(sa), len(sb))))
    counts = collections.Counter(x for _, links, _ in rows for x in links)
    high = collections.defaultdict(int)
    for (_, y), n in counts.items():
        high[y] = max(high[y], n)
    out = []
    for groups, links, n in rows:
        n_a, n_b = n or (0, 0)
        line = ";".join(f"{x}|{y}" for x, y in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(counts[x] == high[x[1]] for x in links), sum(counts[x] for x in links), sha(line) if groups else ""))
    return out


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def short(texts, n=600):
    return [t if t is None else t[:n] for t in texts]


def test_alignment_edges_and_columns(spark):
    texts = short(MORE)
    df = table(spark, texts, n_best=["x"] * len(texts), KEY=["y"] * len(texts))
    done = alignment.align(df, PLAIN, PATTERN, PIECES, keep_groups=True)
    assert done.columns == ["doc_id", "KEY", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    got = {r.doc_id: r for r in done.collect()}
    assert len(got) == len(texts)
    for i, want in enumerate(aligned_by_loops(texts)):
        assert tuple(got[i][c] for c in NAMES) == want, texts[i]
        assert want[-1] == (sha(got[i].groups) if got[i].groups else "")
    assert alignment.align(df.where("false"), PLAIN, PATTERN, PIECES).collect() == []


def test_alignment_in_many_slices(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_BYTES", 1)
    texts = ["the cat sat", "the cat", "unbelievable weather", "the cat sat", "", None, "weather the"] * 3
    got = {r.doc_id: r for r in alignment.align(table(spark, texts).repartition(3), PLAIN, PATTERN, PIECES).collect()}
    for i, want in enumerate(aligned_by_loops(texts)):
        assert tuple(got[i][c] for c in NAMES) == want


def test_op12_equals_loops(spark):
    rows = texts_of(spark).collect()
    got = {r.doc_id: r for r in queries.op12_tokenizer_alignment(spark, SF).collect()}
    assert len(got) == len(rows)
    for r, want in zip(rows, aligned_by_loops([r.text for r in rows]), strict=True):
        assert tuple(got[r.doc_id][c] for c in NAMES) == want


# ---- 13: runs -----------------------------------------------------------

def runs_by_brute_force(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i - start + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng = random.Random(2)
    docs = []
    for k in range(1200):
        letters, n = rng.choice([1, 2, 2, 3, 5, 20]), rng.randint(0, 80)
        w = [str(rng.randint(0, letters - 1)).encode() for _ in range(n)]
        if k % 3 == 0 and n > 10:
            p, at = rng.randint(1, 6), rng.randint(0, n - 1)
            w = w[:at] + (w[at:at + p] * 40)[:rng.randint(0, 50)] + w[at:]
        docs.append(w * rng.randint(1, 6) if k % 7 == 0 else w)
    for i in range(0, len(docs), 60):
        assert periodic.runs_of(docs[i:i + 60]) == [runs_by_brute_force(w) for w in docs[i:i + 60]]


@pytest.mark.parametrize(("words", "want"), [
    ([b"a"] * 100_000, [(0, 100_000, 1)]),
    ([str(i % 700).encode() for i in range(100_000)], [(0, 100_000, 700)]),
    ([x for i in range(12_000) for x in (b"a", b"b", b"c", b"d", b"e", b"f", b"g", str(i).encode())], []),
    ([b"ab"[:1]] * 5, []), ([b"x"] * 6, [(0, 6, 1)]), ([b"x", b"y"] * 3, []), ([b"x", b"y"] * 4, [(0, 8, 2)])])
def test_runs_of_long_and_short_patterns(words, want):
    assert periodic.runs_of([words]) == [want]


def test_best_run_is_exact():
    assert periodic.best_run([]) is None
    assert periodic.best_run([(5, 9, 2), (3, 18, 4), (0, 13, 3)]) == (3, 18, 4)  # 4.5 twice: the smaller start
    big = 10**9
    assert periodic.best_run([(0, 4 * big + 5, big + 1), (1, 4 * big + 1, big)]) == (1, 4 * big + 1, big)  # equal as doubles


def test_find_runs_edges(spark):
    texts = [None, "", " \t\n", "a a a a a a", "a\xa0a a\xa0a a\xa0a a\xa0a a\xa0a a\xa0a", "b " * 3000, "x y z " * 5 + "tail", "x y z " * 5 + "tail", "one two"]
    df = table(spark, texts, runs=["x"] * len(texts), n_words=["y"] * len(texts))
    done = periodic.find_runs(df)
    assert done.columns == ["doc_id", "n_words", "runs", "best", "collapsed"]
    rows = {r.doc_id: r for r in done.collect()}
    for i, t in enumerate(texts):
        w = (t or "").encode().split()
        want = runs_by_brute_force(w)
        assert [tuple(x) for x in rows[i].runs] == want and rows[i].n_words == len(w)
        assert (rows[i].best and tuple(rows[i].best)) == periodic.best_run(want)
    assert rows[6].collapsed == "x y z tail" and rows[3].collapsed == "a" and rows[8].collapsed == "one two" and rows[0].collapsed == ""
    assert periodic.find_runs(df.where("false")).collect() == []


def test_op13_equals_brute_force(spark):
    docs = texts_of(spark).collect()
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    some = 0
    for r in docs:
        w = (r.text or "").encode().split()
        n, h = len(w), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if len(w) > 6000:  # brute force takes the square of the words
            continue
        want = runs_by_brute_force(w)
        some += bool(want)
        drop = {i for s, m, q in want for i in range(s + q, s + m)}
        best = min(want, key=lambda x: (-x[1] / x[2], x[0], x[2])) if want else (None,) * 3
        g = got[r.doc_id]
        assert (g.n_runs, (g.start, g.length, g.period)) == (len(want), best)
        assert g.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert g.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in want))
        assert g.collapsed_sha256 == sha(b" ".join(x for i, x in enumerate(w) if i not in drop).decode())
    assert some > 5


def test_repeated_tails_without_ids_or_words(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    df = spark.createDataFrame([(ids[0], None), (ids[1], "  "), (None, "a b"), (ids[2], "p q r")], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in queries.repeated_tails(df).collect()}
    assert rows[ids[0]] is None and rows[ids[1]] == "  " and rows[None] == "a b" and len(rows[ids[2]].split()) == 3
