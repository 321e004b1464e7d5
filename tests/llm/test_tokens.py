import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, pre_tokenizers

from mercatura.llm import grammar, packing, tokens, wordpiece

PATH = public_tokenizers.path("word_bpe_49k.json")
DEFINITION = tokens.read_definition(PATH)
ODD = [
    "", " ", "the", "The.", "it's I'M we'll", "don't'", "café", "CAFÉ", "café", "naïve%%%", "日本語", "Σίσυφος ΟΔΟΣ",
    "\xa0", "\x85", "\x1c", " ", "\x0b", "\n", "\t", "<|endoftext|>", "a<|startoftext|>b", "<|endof", "१२३", "a_b", "12,5€",
    "İI", "ſt ß ẞ", "🙂👍🏽", "​", "﻿", "#$&*", "'S", "x" * 300, "''s", "½²ª", "́", "\r\n", "ǅ", "½", "\x00", "­",
]


def texts(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choice([*ODD, " ", " ", "e", "T"]) for _ in range(draw.randint(0, 12))) for _ in range(n)]


def library(found):
    whole = Tokenizer.from_file(PATH)
    return [whole.encode(t or "", add_special_tokens=False).ids for t in found]


def test_encoder_is_the_library(monkeypatch):
    monkeypatch.setattr(tokens, "WORDS", 40)
    monkeypatch.setattr(tokens, "PIECES", 30)
    found = [*ODD, *texts(1, 3000), None]
    one = tokens.Encoder(DEFINITION)
    got = [ids for k in range(0, len(found), 7) for ids in one.encode(found[k : k + 7])]
    for text, ids, want in zip(found, got, library(found), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == want, repr(text)
    other = tokens.read_definition(public_tokenizers.path("byte_bpe_50k.json"))
    assert not tokens.Encoder(other).short_way


def test_merges_of_pieces_are_the_library():
    one = tokens.Encoder(DEFINITION)
    library = Tokenizer(one.whole.model)
    library.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    text = lambda t: (one.merges.code(t) or b"").rstrip(tokens._MARK).decode(errors="replace")
    vocabulary = {t: i for t, i in one.whole.get_vocab().items() if tokens._PIECE.fullmatch(text(t))}
    assert len(vocabulary) > 40_000
    # the text of a token that ends a word is merged to that token
    ended = [t for t in vocabulary if t.endswith("</w>")]
    got = library.encode(" ".join(t[:-4] for t in ended), add_special_tokens=False).ids
    assert got == [vocabulary[t] for t in ended]
    draw = random.Random(6)
    letters = "etaoinshrdlucmfwypvbgkjqxz" + "àâäçéèêëîïôöùûüßñáíóú"
    tops = [t.removesuffix("</w>") for t in list(vocabulary)[600:6000] if t.removesuffix("</w>").isascii()]
    pieces = {"".join(draw.choices(letters, weights=range(len(letters), 0, -1), k=draw.randint(1, 14))) for _ in range(8000)}
    pieces |= {"".join(x for x in draw.choices(tops, k=draw.randint(1, 4)) if x.isalpha()) for _ in range(8000)} - {""}
    pieces |= {"".join(draw.choices("!-/:;%$#*=~", k=draw.randint(1, 9))) for _ in range(500)}
    pieces = sorted({p.lower() for p in pieces} | {"1", "9"})
    whole = Tokenizer.from_file(PATH)
    for piece, ids in zip(pieces, one.merges.encode(pieces), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(piece, add_special_tokens=False).ids, piece


def test_marked_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 60)
    draw = random.Random(8)
    signs = ["the", "a", "é", "ß1", "12", " ", " ", "\n", "\t", "\r", ",", "..", "-x", "(b)", "ÿ", "~!"]
    found = ["".join(draw.choices(signs, k=draw.randint(0, 60))) for _ in range(400)] + ["", " ", "x"]
    assert tokens.marked(found) == [tokens._PIECE.sub("\\g<0>\x01", t) for t in found]


def test_no_pair_is_left_that_can_be_replaced_often():
    draw = np.random.default_rng(3)
    for _ in range(300):
        n = int(draw.integers(1, 120))
        ids = draw.integers(0, int(draw.integers(1, 5)), n)
        ends = np.unique(np.append(draw.integers(1, n + 1, int(draw.integers(0, 4))), n))
        rules, symbols, cut = grammar.compress(ids, ends, 10)
        assert grammar.expand(symbols.copy(), rules, 10).tolist() == ids.tolist()
        spelled = grammar.Expansions(rules, grammar.expansion_lengths(rules, 10), 10)
        assert spelled.of(symbols).tolist() == ids.tolist()
        uses = defaultdict(int)
        for a, b in zip([0, *cut[:-1]], cut, strict=True):
            text = symbols[a:b].tolist()
            for pair in set(zip(text, text[1:])):
                at = 0
                while at < len(text) - 1:
                    hit = (text[at], text[at + 1]) == pair
                    uses[pair] += hit
                    at += 1 + hit
        assert max(uses.values(), default=0) < grammar.FREQUENT


def test_automaton_is_greedy():
    draw = random.Random(2)
    for _ in range(300):
        make = lambda: {"".join(draw.choice("abc") for _ in range(draw.randint(1, 4))).encode() for _ in range(6)}
        first, inner = make(), make()
        found = wordpiece.Automaton(first, inner)
        for _ in range(60):
            word = "".join(draw.choice("abc") for _ in range(draw.randint(0, 9))).encode()
            at, n = 0, 0
            while at < len(word):
                ends = [e for e in range(len(word), at, -1) if word[at:e] in (inner if at else first)]
                if not ends:
                    n = 1
                    break
                at, n = ends[0], n + 1
            assert found.count(word) == n, (first, inner, word)


def test_counts(spark, rows):
    docs = spark.createDataFrame([(1, "ab abc  zz"), (1, ""), (None, None), (2, "ab ab")], "doc_id long, text string")
    got = wordpiece.count_pieces(docs, [b"a", b"ab"], [b"b", b"c"])
    assert rows(got) == sorted([(1, 3, 4), (1, 0, 0), (None, 0, 0), (2, 2, 2)], key=repr)
    assert wordpiece.count_pieces(docs.limit(0), [b"a"]).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_closest_multiset(seed):
    draw = random.Random(seed)
    lengths = {draw.randint(1, 30): draw.randint(1, 3) for _ in range(draw.randint(0, 6))}
    room = draw.randint(0, 60)
    sums = {0}
    for length, n in lengths.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
    chosen = packing.closest_multiset(lengths, room)
    assert sum(x * n for x, n in chosen.items()) == max(sums)
    assert all(0 < n <= lengths[x] for x, n in chosen.items())


@pytest.mark.parametrize("seed", range(30))
def test_sequences_are_full_or_powers_of_two(seed, monkeypatch):
    draw = random.Random(seed)
    monkeypatch.setattr(packing, "WINDOW", draw.choice([8, 200, 5000]))
    sizes = [draw.randint(1, draw.choice([5, 90, 700])) for _ in range(draw.randint(0, 60))]
    docs = [packing.Piece(k, 0, n, bytes([k % 251]) * (4 * n)) for k, n in enumerate(sizes)]
    found = list(packing.sequences(iter(docs), 64))
    assert all(n <= 64 and n & (n - 1) == 0 for n in (sum(map(len, s)) for s in found))
    places = {k: [] for k in range(len(sizes))}
    for piece in (p for s in found for p in s):
        places[piece.doc_id] += range(piece.start, piece.start + len(piece))
    assert all(sorted(places[k]) == list(range(n)) for k, n in enumerate(sizes))


def test_packing(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(texts(3, 400))] + [(7, "again " * 500), (None, None), (9, "")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, start int").repartition(3)
    got = packing.pack(docs, DEFINITION, capacity=64).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id, r.doc_tokens].append((r.start, r.ids))
    for pieces in by_sequence.values():
        upto = 0
        for offset, length in sorted(pieces):
            assert offset == upto
            upto += length
        assert upto <= 64 and upto & (upto - 1) == 0
    want = defaultdict(bytes)
    for (doc_id, text), ids in zip(rows, library([t for _, t in rows])):
        want[doc_id, len(ids) + 1] += np.array([*ids, 2], dtype="<u4").tobytes()
    assert {k: b"".join(x for _, x in sorted(v)) for k, v in by_doc.items()} == dict(want)
    assert packing.pack(docs.limit(0), DEFINITION).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_grammar_round_trip(seed):
    draw = np.random.default_rng(seed)
    docs = [draw.integers(0, 3 + 5 * seed, draw.integers(1, 400)) for _ in range(20)]
    docs += docs[:5] + [np.zeros(300, np.int64), np.zeros(1, np.int64)]
    ids = np.concatenate(docs)
    sizes = [len(d) for d in docs]
    terminals = 100 if seed % 2 else 70_000
    rules, symbols, ends = grammar.compress(ids, np.cumsum(sizes), terminals)
    assert len(symbols) + 2 * len(rules) < len(ids)
    row = {
        "terminals": terminals, "doc_ids": list(range(len(docs))), "n_ids": sizes, "rules": rules.astype("<u4").tobytes(),
        "expansions": grammar.expansion_lengths(rules, terminals).astype("<u4").tobytes(),
        "body": symbols.astype("<u4").tobytes(), "width": 4, "body_ends": ends,
    }
    shard = grammar.Shard(row)
    for k, (doc, got) in enumerate(zip(docs, shard.documents(), strict=True)):
        assert np.array_equal(doc, got)
        a, b = sorted(draw.integers(0, len(doc) + 1, 2))
        assert np.array_equal(doc[a:b], shard.read(k, a, b))


def test_token_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(grammar, "LEAST_RANGES", 5)
    rows = [(k * 7 % 401, t) for k, t in enumerate(texts(4, 400))] + [(None, None), (500, "the cat " * 3000), (501, "")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, shard int").repartition(3)
    grammar.write_tokens(docs, f"{tmp_path}/t", DEFINITION)
    got = grammar.read_tokens(spark, f"{tmp_path}/t").collect()
    rows.sort(key=lambda r: -1 if r[0] is None else r[0])
    upto = 0
    for r, (doc_id, _), ids in zip(sorted(got, key=lambda r: r.start), rows, library([t for _, t in rows]), strict=True):
        assert (r.doc_id, r.start) == (doc_id, upto)
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == [*ids, 1]
        upto += len(ids) + 1
    grammar.write_tokens(docs.limit(0), f"{tmp_path}/e", DEFINITION)
    assert grammar.read_tokens(spark, f"{tmp_path}/e").count() == 0


@pytest.mark.parametrize("terminals", [300, 65530])
def test_pairs_are_replaced_until_none_is_frequent(terminals):
    draw = np.random.default_rng(3)
    passages = [np.tile(draw.permutation(300), 1), np.full(4096, 7), np.tile([1, 2, 3], 500)]
    for passage in passages:
        copies = 40
        ids, ends = np.tile(passage, copies), np.arange(1, copies + 1) * len(passage)
        rules, symbols, found = grammar.compress(ids, ends, terminals)
        assert (grammar.expand(symbols, rules, terminals) == ids).all()
        assert len(symbols) == len(found) == copies
