"""The helpers of the corpus operators against plain definitions."""

import base64
import collections
import io
import itertools
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers
from hypothesis import given, settings, strategies as st

from tidemark.llm import bpe, common, language, near_join, order_minhash, pieces, quality_model, quality_rules, sharding, token_files

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.text(alphabet="ab é1.'s \n\t　🙂l", max_size=60)

WHOLE = {}


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packed_integers_come_back(values):
    values = np.unique(np.array(values, np.uint64))
    assert common.unpack_sorted(common.pack_sorted(values)).tolist() == values.tolist()


@given(TEXTS)
def test_pieces_rejoin_and_cut_before_white_space(text):
    parts = pieces.cut(text)
    assert "".join(parts) == text
    pattern = bpe.regex.compile(public_tokenizers.PATTERN)
    assert [p for part in parts for p in pattern.findall(part)] == pattern.findall(text)


@pytest.fixture(scope="module")
def reference():
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(text=TEXTS)
def test_encoding_equals_the_reference_library(reference, text):
    own = bpe.coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = np.frombuffer(own.encode([text])[0], "<i4").tolist()
    assert ids == reference.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab1!' \n\t\x0b\x1c\x85\xa0\u2003\u3000\u00e9\u0558\ua7ce\u6f22"))), max_size=6))
def test_ids_of_pieces_equal_the_ids_of_whole_texts(texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = tokenizers.Tokenizer.from_file(path) if path not in WHOLE else WHOLE[path]
    WHOLE[path] = model
    found = [np.frombuffer(x, "<i4").tolist() for x in token_files._pieces(path).ids(texts)]
    assert found == [model.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(parts=st.lists(st.sampled_from(["<|endoftext|>", "a", " ", "\n", "<|", "'s", "1", "\u3000"]), max_size=8))
def test_names_of_added_tokens_become_one_id(parts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = np.frombuffer(token_files._pieces(path).ids(["".join(parts)])[0], "<i4").tolist()
    assert found == tokenizers_of(path).encode("".join(parts), add_special_tokens=False).ids
    assert found.count(50256) == parts.count("<|endoftext|>")


def tokenizers_of(path):
    if path not in WHOLE:
        WHOLE[path] = tokenizers.Tokenizer.from_file(path)
    return WHOLE[path]


def test_long_pieces_are_not_remembered():
    own = bpe.coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    text = "x" * 5000 + " y"
    assert own.decode(np.frombuffer(own.encode([text])[0], "<i4").tolist()) == text.encode()
    assert max(map(len, own.pieces)) <= pieces.LONG


def test_facts_and_hot_members_of_two_blocks_never_meet():
    same = [np.arange(3, dtype=np.uint64)] * (near_join.HOT + 1)
    keys = [bytes([i]) * 16 for i in range(len(same))]
    blocks = [task << 32 | place for task in range(50) for place in range(3)]
    found = [near_join._block(n, [None] * len(same), same, keys, 2).to_pylist() for n in blocks]
    own = [{r["key"] for r in rows if r["kind"] in (near_join._FACTS, near_join._MEMBERS)} for rows in found]
    assert all(len(k) == 1 and max(k) < 0 for k in own) and len(set.union(*own)) == len(blocks)


@given(st.lists(st.sampled_from(["a", "b", "c"]), max_size=30))
def test_repeated_words(words):
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    assert quality_rules.measure(" ".join(words))[4] == len(covered)


def test_rules_that_confirm_each_other_are_believed():
    votes = np.array([[1, 1, 1], [-1, -1, 1], [1, 1, 0], [1, 1, -1]])
    share, right = quality_rules.estimate(votes, np.array([800.0, 150, 40, 10]))
    good, bad = quality_rules.weights(right)
    odds = np.log(share / (1 - share)) + (votes > 0) @ good + (votes < 0) @ bad
    assert (odds > 0).tolist()[:3] == [True, False, True]


def test_estimate_without_documents():
    share, right = quality_rules.estimate(np.zeros((0, 2), int), np.zeros(0))
    assert 0 < share < 1 and right.shape == (2, 2)


@given(TEXTS, st.integers(1, 5))
def test_occurrence_numbers_make_kmers_distinct(text, _):
    kmers = order_minhash.numbered_kmers(order_minhash.points_of(text))
    assert len(kmers) == (max(1, len(text) - order_minhash.K + 1) if text else 0)
    assert len(np.unique(kmers)) == len(kmers)


def test_fingerprints_see_the_order_of_passages():
    a, b = "one passage about rivers and hills. " * 3, "quite another text on ships at sea! " * 3
    print_of = lambda t: order_minhash.fingerprint(order_minhash.points_of(t))
    assert order_minhash.likeness(print_of(a + b), print_of(a + b)) == 1
    assert order_minhash.likeness(print_of(a + b), print_of(b + a)) < 1
    assert order_minhash.likeness(print_of(a + b), print_of(a + b + "x")) > order_minhash.likeness(print_of(a), print_of(b))
    assert order_minhash.likeness(print_of(""), print_of("")) == 1 and len(print_of("abc")) == order_minhash.M


@settings(deadline=None)
@given(st.lists(st.lists(st.floats(-30, 0), min_size=3, max_size=3), min_size=1, max_size=6))
def test_the_short_way_is_as_good_as_every_path(rows):
    scores, switch = np.array(rows), 5.0

    def value(path):
        return sum(scores[i, p] for i, p in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))

    best = max(map(value, itertools.product(range(3), repeat=len(rows))))
    assert value(language.path_of(scores, switch)) == pytest.approx(best)
    assert value(language.viterbi(scores, switch)) == pytest.approx(best)


def test_a_path_without_the_best_single_language_is_found():
    scores = np.array([[0.0, -20, -9], [-20, 0, -9]])  # all of the third: -18; the first, then the second: -15
    assert language.path_of(scores, 15.0).tolist() == [0, 1] == language.viterbi(scores, 15.0).tolist()


def test_words_know_place_and_script():
    words = language.words_of(["Ab1 é", None, "мир"])
    assert list(zip(words.text, words.begin - words.starts[words.text], words.end - words.starts[words.text])) == [
        (0, 0, 2), (0, 4, 5), (2, 0, 3)
    ]
    names = list(language.SCRIPTS)
    assert [names[s] for s in words.script] == ["latin", "latin", "cyrillic"]


def test_shapes():
    assert [quality_model.shape(w) for w in ("Hello", "ABC!!", "a%%%", "12-34")] == ["Aa", "A!", "a%", "0-0"]


def test_shapes_of_long_words():
    assert quality_model.shape("a" * 40 + "B1%") == "aA0%"


def test_training_tells_shouting_from_prose():
    letters = "abcdefghijklmnopqrstuvwxyz"
    prose = [" ".join(letters[i * j % 23 :][:4] for j in range(40)) for i in range(1, 60)]
    weights = quality_model.train(prose + [p.upper() + "!!" for p in prose], [1] * 59 + [0] * 59)
    memo = quality_model._Words()
    value = lambda t: weights[quality_model.grams(t, memo)].sum()
    assert value("some other lines of text") > value("SOME OTHER LINES OF TEXT")


@given(st.lists(st.integers(1, 1000), max_size=40), st.integers(1, 5))
def test_differencing_places_every_part(sizes, shards):
    placed = sharding.difference(sizes, shards)
    assert len(placed) == len(sizes) and all(0 <= p < shards for p in placed)
    if sizes:
        loads = [sum(s for s, p in zip(sizes, placed) if p == k) for k in range(shards)]
        assert max(loads) - min(loads) <= max(sizes)


def test_differencing_example():
    # 8 7 6 5 4 in two: differencing gives 16 and 14.
    placed = sharding.difference([8, 7, 6, 5, 4], 2)
    assert sorted(sum(s for s, p in zip([8, 7, 6, 5, 4], placed) if p == k) for k in (0, 1)) == [14, 16]


def _file(documents, frame_ids=4):
    out = io.BytesIO()
    writer = token_files.Writer(out, frame_ids)
    for doc_id, ids in documents:
        writer.add(doc_id, np.array(ids, "<u4").tobytes())
    writer.close()
    return out


def test_a_reader_opens_only_the_frames_it_needs():
    documents = [(None, []), (1, [5, 6]), (7, [1, 2, 3]), (9, [4]), (9, [8] * 9)]
    reader = token_files.Reader(_file(documents))
    back = [reader.document(k) for k in range(len(documents))]
    assert [(d, np.frombuffer(raw, "<u4").tolist()) for d, _, raw in back] == [(d, list(i)) for d, i in documents]
    assert [s for _, s, _ in back] == [0, 0, 2, 5, 6] and reader.find([9]) == [3, 4]
    opened = []
    reader.last, plain = (None, b""), reader.frame
    reader.frame = lambda i: opened.append(i) or plain(i)
    reader.document(4)
    assert opened == [1]


def test_a_damaged_frame_is_noticed():
    out = _file([(1, list(range(100)))], 1000)
    data = bytearray(out.getvalue())
    data[20] ^= 1
    with pytest.raises(Exception):
        token_files.Reader(io.BytesIO(bytes(data))).document(0)


def test_other_decompressors_skip_the_tables():
    out = _file([(1, [1, 2, 3]), (2, [4, 5, 6, 7])])
    import zstandard

    raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert np.frombuffer(raw, "<u4").tolist() == [1, 2, 3, 4, 5, 6, 7]
