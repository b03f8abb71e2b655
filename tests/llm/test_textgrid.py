"""Hashes of words."""

import random

import pyarrow as pa

from solvind.llm.textgrid import chunks, words


def hashes(texts):
    return [values.tolist() for _, rows, data, offsets in chunks(pa.array(texts)) for values, before in [words(data, offsets)]]


def one(word):
    return hashes([word])[0][0]


def test_structured_words_differ():
    even, odd = "a", "b"
    for _ in range(10):
        even, odd = even + odd, odd + even
    assert len(even) == 1024 and one(even) != one(odd)  # words that a polynomial modulo a power of two cannot tell apart
    long = "".join(chr(97 + k % 26) for k in range(70_000))
    swapped = "z" + long[1:65_536] + long[0] + long[65_537:]
    assert one("z" + long[1:]) != one(long) and one(swapped) != one(long)
    assert one(long[8:16] + long[:8] + long[16:]) != one(long)
    assert len({one("x" * n) for n in range(1, 300)}) == 299 and one("a\0") != one("a") != one("a\0\0")
    blocks = ["".join(random.Random(k).choices("ab", k=8)) for k in range(6)]
    assert len({one("".join(blocks[i] for i in order)) for order in ([0, 1, 2, 3], [3, 2, 1, 0], [1, 0, 2, 3], [0, 1, 3, 2], [0, 0, 1, 1], [1, 1, 0, 0])}) >= 5


def test_a_word_has_one_hash_wherever_it_stands():
    source = random.Random(3)
    vocabulary = ["".join(source.choice("abcé中") for _ in range(source.randint(1, 30))) for _ in range(300)]
    given = [source.choices(vocabulary, k=source.randint(0, 60)) for _ in range(50)]
    texts = [" " * source.randint(0, 3) + "".join(word.upper() if word.isascii() and source.random() < 0.3 else word for word in [w]) + "\t \n" for ws in given for w in ws]
    flat = [word for ws in given for word in ws]
    assert len({one(w) for w in vocabulary}) == len(set(vocabulary))
    names = {w: one(w) for w in vocabulary}
    assert sum(hashes(texts), []) == [names[w] for w in flat]
    joined = ["  ".join(ws) + " " for ws in given]
    assert sum(hashes(joined), []) == [names[w] for w in flat]
