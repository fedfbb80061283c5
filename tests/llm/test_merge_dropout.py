"""Merge dropout against a plain agenda that looks at all neighbours anew for each candidate."""

import random

import numpy as np
import pytest

from tidewheel.llm import pieces, queries, words

pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def own():
    return pieces.Pieces(queries.tokenizer_path("piece_bpe_32k.model"), 50)


def plain_words(own, text, key, seed):
    """Each word of a text with the key of its draws."""
    start = words.mix(np.array([key], np.uint64) ^ words.mix(np.array([seed], np.uint64)))
    for place, word in enumerate(own.words.findall(" " + text)):
        yield word, words.mix(start + np.uint64(place))


def plain_ids(own, word, key, dropout):
    """Best score first, leftmost among equals; what is skipped comes back when a neighbour has changed."""
    parts, skipped, came = [(i, i + 1) for i in range(len(word))], set(), 0
    lanes = int(pieces.skips(key, dropout)[0])
    while True:
        pairs = [
            (own.rank[word[a:c]], a, c, at) for at, ((a, _), (_, c)) in enumerate(zip(parts, parts[1:]))
            if word[a:c] in own.rank and (a, c) not in skipped
        ]
        if not pairs:
            break
        _, a, c, at = min(pairs)
        skip = lanes >> came & 1 if came < pieces.LANES else pieces.later_skips(key[0], came, 1, dropout)[0]
        came += 1
        if skip:
            skipped.add((a, c))
        else:
            parts[at : at + 2] = [(a, c)]
    ids = []
    for a, b in parts:
        known = own.id.get(word[a:b])
        ids += [known] if known is not None else [own.byte[x] for x in word[a:b].encode()]
    return ids


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 0.95])
def test_against_a_plain_agenda(own, dropout):
    draw = random.Random(7)
    some = [w.strip() or w for w in own.id if len(w) < 12]
    texts = ["", " ", "   a  ", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "日本語 ☃☃ é́ naïve\n\n\tx", "_" * 70, "▁ ▁a"]
    for _ in range(150):
        texts.append("".join(draw.choice(some) + draw.choice(["", "", " ", "  ", "\n", "☃"]) for _ in range(draw.randrange(1, 30))))
    texts += texts[-20:]
    keys = np.array([draw.randrange(1 << 63) for _ in texts], np.uint64)
    found = own.encode_all(texts, keys, 3, dropout)
    for text, key, ids in zip(texts, keys.tolist(), found):
        expected = [i for word, k in plain_words(own, text, key, 3) for i in plain_ids(own, word, k, dropout)] if text else []
        assert ids.tolist() == expected, text


def test_kept_words_change_no_result(own):
    path = queries.tokenizer_path("piece_bpe_32k.model")
    texts = [f"words of text {i % 7} and others{i}, und andere {i * i}" for i in range(60)]
    keys = words.keyed(5, len(texts))
    whole = own.encode_all(texts, keys, 1, 0.3)
    other = pieces.Pieces(path, 1)
    for text, key, ids in zip(texts, keys.tolist(), whole):
        assert other.encode(text, key, 1, 0.3).tolist() == ids.tolist()


def test_one_letter_many_times(own):
    """A word beyond the lanes draws by its own key at each place."""
    text = " ".join(["ab" * 200] * 4 + ["anticonstitutionnellementxyz" * 3] * 4)
    (ids,) = own.encode_all([text], np.array([9], np.uint64), 1, 0.2)
    expected = [i for word, k in plain_words(own, text, 9, 1) for i in plain_ids(own, word, k, 0.2)]
    assert ids.tolist() == expected
