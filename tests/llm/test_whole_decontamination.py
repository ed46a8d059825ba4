"""Benchmark rows that share an id with different texts, or have none; all windows by brute force."""

import math
import random
import time
from collections import Counter

from listingflow.llm.decontaminate import contaminated


def test_every_text_of_an_item_is_searched(spark):
    text = lambda name, n=30: " ".join(f"{name}{k}" for k in range(n))
    bench = [(1, text("a")), (1, text("b")), (None, text("c")), (None, text("d")), (2, text("e"))]
    bench = spark.createDataFrame(bench, "item_id long, text string")
    docs = [(k, text("x", 9) + " " + text(name) + " " + text("y", 9)) for k, name in enumerate("abcdez")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.start, round(r.similarity, 6)) for r in contaminated(docs, bench).collect())
    assert got == [(0, 1, 9, 1.0), (1, 1, 9, 1.0), (2, None, 9, 1.0), (3, None, 9, 1.0), (4, 2, 9, 1.0)]


def shingles(words, size):
    return Counter(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def brute(docs, items, threshold=0.8):
    """The best weighted similarity over every window of every document, for all items."""
    size = {i: min(5, len(w)) for i, w in items.items()}
    own = {i: shingles(w, size[i]) for i, w in items.items()}
    df = Counter(s for c in own.values() for s in c)
    weigh = lambda s: math.log(1 + len(items) / df[s]) if s in df else math.log(1 + len(items))
    found = {}
    for d, words in docs.items():
        for i, item in items.items():
            best = 0.0
            for start in range(max(1, len(words) - size[i] + 1)):
                window = shingles(words[start : start + len(item)], size[i])
                both = sum(min(window[s], own[i][s]) * weigh(s) for s in window.keys() & own[i].keys())
                if both:
                    every = sum(max(window[s], own[i][s]) * weigh(s) for s in window.keys() | own[i].keys())
                    best = max(best, both / every)
            if best >= threshold:
                found[d, i] = round(best, 6)
    return found


def checked(spark, docs, items):
    text = " ".join
    rows = spark.createDataFrame([(d, text(w)) for d, w in docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(i, text(w)) for i, w in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in contaminated(rows, bench).collect()}
    return got, brute(docs, items)


def test_words_put_in_between_boilerplate_ends(spark):
    """The best window begins between the places of the shingles that it shares."""
    word = lambda i, n: [f"w{i}x{k}" for k in range(n)]
    head, foot = word("h", 9), word("f", 9)
    items = {i: head + word(i, 83) + foot for i in range(31)}
    body = items[4][9:-9]
    docs = {1: word("n", 20) + head + body[:40] + word("z", 10) + body[40:] + foot + word("m", 20), 2: word("q", 200)}
    got, want = checked(spark, docs, items)
    assert want and got == want


def test_changed_passages_equal_brute_force(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdefghij", k=5))
    common = [word() for _ in range(12)]
    items = {i: [word() for _ in range(draw.randint(20, 70))] + (common if i % 3 == 0 else []) for i in range(24)}
    docs = {}
    for d in range(70):
        words = list(items[draw.randrange(24)])
        for _ in range(draw.randint(0, 4)):
            at = draw.randrange(len(words))
            change = draw.random()
            if change < 0.4:
                words[at:at] = [word() for _ in range(draw.randint(1, 6))]
            elif change < 0.7:
                del words[at : at + draw.randint(1, 5)]
            else:
                words[at] = word()
        docs[d] = [word() for _ in range(draw.randint(0, 30))] + words + [word() for _ in range(draw.randint(0, 30))]
    got, want = checked(spark, docs, items)
    assert len(want) > 20 and set(got) <= set(want)
    assert sum(got.get(k) == v for k, v in want.items()) >= 0.97 * len(want), set(want) - set(got)


def test_long_documents_of_one_word(spark):
    rows = spark.createDataFrame([(1, "same " * 64_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "same " * 30)], "item_id long, text string")
    begun = time.time()
    assert [r.similarity for r in contaminated(rows, bench).collect()] == [1.0]
    assert time.time() - begun < 60
