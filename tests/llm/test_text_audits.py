"""Token encoding, source divergence and conversation repair against the tokenizer library, SQL and brute force."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from curiomill.llm import bpe, divergence
from curiomill.llm import conversations as C

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def strings():
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyzABC ÀÉÖßΣσİıǅ0123456789'.,-_\n\t　日本한국̄́🙂\U0001F468‍"
    rows = [
        "", None, " \n ", "Hello, World's   <|endoftext|>it's <|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext", "ΑΣ ΟΔΟΣ Σ İstanbul",
        "naïve café ﬁ", "aaaaaaaaaaaaa " * 3, "a" * 5000, "tab\x1c\x1f\x85 y", "\x00\x01", "Ᲊ ꟎՘ x", "the same", "the same", "x " * 5000,
    ]
    rows += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(300)]
    rows += ["".join(rng.choice("etaoinshrdlucmfw") for _ in range(rng.randint(200, 2000))) for _ in range(6)]
    rows += ["".join(chr(c) for c in (rng.randrange(0x110000) for _ in range(40)) if not 0xD800 <= c < 0xE000) for _ in range(60)]
    return rows


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(PATH)


def test_digests_are_those_of_the_library(spark, strings, library):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(strings)], "doc_id long, text string, ids string, decoded int")
    made = {r.doc_id: r for r in bpe.digests(docs, PATH).collect()}
    assert len(made) == len(strings)
    for i, t in enumerate(strings):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want = (i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))))
        assert tuple(made[i]) == want, t


def test_encoder_forgets_and_goes_on(strings, library, monkeypatch):
    want = [library.encode(t or "", add_special_tokens=False).ids for t in strings]
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 50)
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 30)
    assert [x.tolist() for x in bpe.Encoder(bpe.Vocabulary(PATH)).encode(strings)] == want


def test_both_ways_of_merging_agree(library):
    v, rng = bpe.Vocabulary(PATH), random.Random(2)
    words = ["".join(rng.choice("abcdeé日") for _ in range(rng.randint(1, 200))).encode() for _ in range(200)]
    ids, size = bpe.encode_words(v, words)
    data = np.frombuffer(b"".join(words), np.uint8)
    symbol, end = v.inside[data], np.cumsum([len(w) for w in words]) - 1
    symbol[end] = v.last[data[end]]
    again, word = bpe._by_rank(v, symbol, np.repeat(np.arange(len(words)), [len(w) for w in words]))
    assert ids.tolist() == again.tolist() and np.bincount(word).tolist() == size.tolist()


def test_ids_round_trip_and_edges(spark):
    rows = spark.createDataFrame([(1, [320, -1, 49407, 10**6, 5]), (2, []), (3, None), (4, [None, 0])], "k int, ids array<int>")
    v = bpe.Vocabulary(PATH)
    want = {1: f"{v.tokens[320]} <|endoftext|> {v.tokens[5]}", 2: "", 3: "", 4: v.tokens[0]}
    assert {r.k: r.decoded for r in bpe.decode(rows, PATH).collect()} == want
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(empty, PATH).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(P.path("byte_bpe_50k.json"))


# -- divergence


def _by_hand(rows, least, top):
    found = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for _, t, _, _ in rows]
    keys = [(lang or "", source or "") for _, _, lang, source in rows]
    docs, counts = {}, {}
    for (lang, source), terms in zip(keys, found, strict=True):
        for t in set(terms):
            docs[lang, t] = docs.get((lang, t), 0) + 1
        for t in terms:
            counts[lang, source, t] = counts.get((lang, source, t), 0) + 1
    out = set()
    for lang in {k[0] for k in keys}:
        terms = sorted(t for g, t in docs if g == lang and docs[g, t] >= least)
        sources = sorted({s for g, s in keys if g == lang})
        table = {s: [counts.get((lang, s, t), 0) for t in terms] for s in sources}
        table[None] = [sum(x) for x in zip(*table.values(), strict=True)]
        p = {s: [1 + 10**9 * (n + 2) // (sum(c) + 2 * len(terms)) for n in c] for s, c in table.items()}

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        for s in sources:
            pairs = [(sum(map(f, p[s], p[o])), o) for o in sources if o != s]
            marks = [(f(x, y), t) for x, y, t, n in zip(p[s], p[None], terms, table[s], strict=True) if n and x > y]
            for part, items in (("pair", pairs), ("term", marks)):
                items.sort(key=lambda v: (-v[0], v[1].encode()))
                out |= {(lang, s, part, i, v, k) for k, (v, i) in enumerate(items[: None if part == "pair" else top], 1)}
    return out


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(4)
    words = ["Alpha", "beta", "gamma9delta", "Ärger", "ärger", "日本", "it's", "x", "Zeta", "zeta", "n/a", "\x85odd", "rare%d"]
    rows = []
    for i in range(400):
        own = " ".join(w % rng.randrange(80) if "%" in w else w for w in (rng.choice(words) for _ in range(rng.randint(0, 12))))
        rows.append((i, own, rng.choice(["en", "en", "de", None]), rng.choice(["s1", "s1", "s2", "s3", "é", None])))
    rows += [(500, None, "en", "silent"), (501, "", "fr", "one"), (502, "1 2", "fr", "two"), (503, "alone", "it", "one"), (504, "alone " * 30_000, "en", "s2")]
    return rows + rows[:40]


@pytest.mark.parametrize(("block", "values", "wide", "held"), [(1 << 13, 1 << 20, 1 << 32, 400_000), (3, 5, 2, 10)])
def test_divergence(spark, sources, monkeypatch, block, values, wide, held):
    for name, value in (("BLOCK_ROWS", block), ("PAIR_VALUES", values), ("WIDE", wide), ("HELD_TERMS", held), ("LONG", 1000)):
        monkeypatch.setattr(divergence, name, value)
    docs = spark.createDataFrame([(*r, 1, "p") for r in sources], "doc_id long, text string, lang string, source string, n int, part string").repartition(3)
    made = [tuple(r) for r in divergence.audit(docs).collect()]
    assert len(made) == len(set(made)) and set(made) == _by_hand(sources, 10, 10)
    assert ("en", "silent", "pair") in {m[:3] for m in made} and ("it", "one") not in {m[:2] for m in made}


def test_divergence_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.audit(empty).collect() == []


def test_pair_sums_use_run_lengths():
    rng = np.random.default_rng(1)
    length = rng.integers(1, 50, 60)
    dense = [rng.integers(1, 4, 60) for _ in range(5)]
    made = {(i, j): v for i, j, v in divergence.pair_sums([divergence.run_lengths(d, length) for d in dense])}
    assert made == {(i, j): int(((dense[i] - dense[j]) ** 2 // (dense[i] + dense[j]) * length).sum()) for i in range(5) for j in range(i + 1, 5)}


# -- conversations


def _repairs(rows):
    """All conversations by a search over whole strings, cheapest and least first."""
    turns: dict = {}
    for c, t, role, text in rows:
        own = turns.setdefault(c, [])
        kind = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [] if kind == 0 else [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = set()
    for c, own in turns.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in own:
            said = re.findall("[^\x20\x09-\x0d]", text)
            faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        known = [t for t, _, _ in own if t is not None]
        heap, done = [(0, "", 0, "", ())], set()
        while True:
            cost, audit, i, last, lines = heapq.heappop(heap)
            if i == len(own) and last in ("", "a"):
                break
            if (i, last) in done:
                continue
            done.add((i, last))
            then = "a" if last == "u" else "u"
            name = {"u": "user:", "a": "assistant:"}[then]
            heapq.heappush(heap, (cost + 5, audit + "I", i, then, (*lines, name)))
            if i < len(own):
                heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, lines))
                if faults[i] not in ("blank", "duplicate"):
                    more, (_, role, text) = cost + 5 * (faults[i] == "truncated"), own[i]
                    heapq.heappush(heap, (more + 1, audit + "R", i + 1, then, (*lines, name + text)))
                    if role[:1] == then or (not last and role[:1] == "s"):
                        heapq.heappush(heap, (more, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out.add((c, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


CONVERSATION = "conv_id long, turn long, role string, text string, piece int, audit string"


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "ü", None, ""]
    texts = ["a.", "b", "Hi there!", " \n ", None, "x? ", "same.", "日本。", "w%d."]
    rows = []
    for c in range(250):
        for t in range(rng.randint(1, 40)):
            if rng.random() < 0.9:
                text = rng.choice(texts)
                rows.append((c or None, t - 3 if rng.random() < 0.97 else None, rng.choice(roles), text and text.replace("%d", str(rng.randrange(50)))))
    rows += [(900, t, "xyz", "fine.") for t in range(30)] + [(901, None, "user", "q?"), (901, None, "assistant", "a.")] + rows[:50]
    dropped = next(i for i in range(1000, 5000) if crc32(f"{i}:7".encode()) % 20 == 0)
    return [*rows, (dropped, 7, "user", "never seen")]


@pytest.mark.parametrize(("turns", "most"), [(4096, 8192), (3, 8192), (1000, 3)])
def test_conversation_repair(spark, talks, turns, most):
    rows = spark.createDataFrame([(*r, 1, "x") for r in talks], CONVERSATION).repartition(5)
    made = [tuple(r) for r in C.repair(C.damaged(rows), turns, most).collect()]
    want = _repairs(talks)
    assert len(made) == len(want) and set(made) == want
    assert any(m[7] == "" and m[8] == hashlib.sha256(b"").hexdigest() for m in made)


def test_no_conversations(spark):
    assert C.repair_damaged(spark.createDataFrame([], CONVERSATION)).collect() == []


def test_string_ids_and_long_texts(spark):
    rows = spark.createDataFrame([("a", 1, "user", "word " * 100_000 + "end?"), ("a", 2, "assistant", "y.")], "conv_id string, turn int, role string, text string")
    [made] = C.repair(rows.withColumn("dropped", F.lit(False))).collect()
    assert (made.audit, made.cost) == ("KK", 0)


def test_colliding_hashes_change_nothing():
    rng = random.Random(6)
    for _ in range(200):
        rows = [C.Row(rng.choice("uasx"), rng.random() < 0.1, rng.random() < 0.2) for _ in range(rng.randint(1, 60))]
        found = []
        for trail in (C.Trail(), C.Trail(modulus=7), C.Trail(modulus=1)):
            cost, node = C.cheapest(trail, C.edits(rows, C.EMPTY, trail))
            found.append((cost, trail.text(node)))
        assert len(set(found)) == 1


def test_strings_of_nodes_compare_like_strings():
    rng = random.Random(7)
    for modulus in ((1 << 61) - 1, 5):
        trail = C.Trail(modulus)
        nodes, said = [0], {0: ""}
        for _ in range(300):
            parent, label = rng.choice(nodes), "".join(rng.choice("DIK") for _ in range(rng.randint(0, 3)))
            node = trail.add(parent, label)
            said[node] = said[parent] + label
            nodes.append(node)
        for _ in range(2000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            assert said[trail.least(a, b)] == min(said[a], said[b]) and trail.text(a) == said[a]
