"""Retrieval against scoring every item with every passage, and the verdict on planted passages."""

import random
from collections import Counter

from rollmill.llm.decontaminate import Index, Settings, clean_only, contaminated, question_and_answer, words_of

r = random.Random(8)
VOCABULARY = ["".join(r.choice("abcdefghij") for _ in range(r.randint(1, 4))) for _ in range(300)]


def sentence(n):
    return " ".join(min(r.choice(VOCABULARY), r.choice(VOCABULARY), key=len) for _ in range(n)) + "."


ITEMS = [(i, f"{sentence(r.randint(5, 20))} {sentence(r.randint(3, 9))}") for i in range(60)] + [(60, sentence(200))]


def index(how):
    counts = Counter(w for _, t in ITEMS for w in set(words_of(t)))
    mean = sum(len(words_of(t)) for _, t in ITEMS) / len(ITEMS)
    return Index(how).build(ITEMS, counts, len(ITEMS), mean)


def brute(texts, how, built):
    """Every segment scored with every passage."""
    out = set()
    for n, words in enumerate(texts):
        for begin in range(-how.stride, len(words), how.stride):
            inside = set(words[max(begin, 0) : begin + how.passage])
            for item, weights in built.segments:
                if sum(w for t, w in weights.items() if t in inside) >= how.threshold:
                    out.add((n, built.items[item][0]))
    return out


def test_no_segment_above_the_threshold_is_missed():
    how = Settings(passage=32, threshold=0.45, question=0, answer=0)
    built = index(how)
    texts = [words_of(sentence(r.randint(0, 150))) for _ in range(60)]
    texts += [words_of(f"{sentence(20)} {t} {sentence(20)}") for _, t in ITEMS[:20]]
    texts += [words_of(" ".join(w for w in t.split() if r.random() < 0.6)) for _, t in ITEMS]
    found = {(n, item) for n, item, *_ in built.search(texts)}
    assert found == brute(texts, how, built) and len(found) > 40


def test_planted_items_are_found(corpus):
    docs = [(i, sentence(300)) for i in range(40)]
    docs += [(100 + i, f"{sentence(r.randint(0, 200))} {t.upper()} {sentence(r.randint(0, 200))}") for i, t in ITEMS]
    # The answer alone, or less than half of an item, is no leak.
    docs += [(300 + i, f"{sentence(50)} {b' '.join(question_and_answer(t)[1]).decode()}") for i, t in ITEMS[:60]]
    df = corpus.createDataFrame(docs, "doc_id long, text string")
    items = corpus.createDataFrame(ITEMS, "item_id long, text string")
    rows = contaminated(df, items).collect()
    assert {(100 + i, i) for i, _ in ITEMS} <= {(x["doc_id"], x["item_id"]) for x in rows}
    assert all(100 <= x["doc_id"] <= 160 for x in rows)
    assert sorted(x["doc_id"] for x in clean_only(df, items).collect()) == [d for d, _ in docs if not 100 <= d <= 160]


def test_large_test_sets_are_searched_index_by_index(corpus, monkeypatch):
    from rollmill.llm import decontaminate

    monkeypatch.setattr(decontaminate, "INDEX_ITEMS", 7)
    df = corpus.createDataFrame([(i, f"{sentence(40)} {t}") for i, t in ITEMS], "doc_id long, text string")
    items = corpus.createDataFrame(ITEMS, "item_id long, text string")
    rows = contaminated(df, items).collect()
    assert {(i, i) for i, _ in ITEMS} <= {(x["doc_id"], x["item_id"]) for x in rows}
    assert clean_only(df, items).count() == 0


def test_odd_rows(corpus, odd, nothing):
    items = corpus.createDataFrame(
        [(1, "One two three."), (None, "another text under the same id, of"), (2, None), (3, "")], "item_id long, text string"
    )
    rows = contaminated(odd, items).collect()
    assert Counter((x["doc_id"], x["item_id"]) for x in rows) == {(4, 1): 2, (5, 1): 1, (5, None): 1}
    assert clean_only(odd, items).count() == odd.count() - 4
    assert clean_only(odd, items).columns == odd.columns
    assert contaminated(nothing, items).collect() == []
    no_items = items.limit(0)
    assert clean_only(odd, no_items).count() == odd.count() and contaminated(odd, no_items).collect() == []
