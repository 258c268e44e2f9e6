"""The stages one after the other over planted documents."""

import random

import corpus_pipeline
from rollmill.session import scratch_path

r = random.Random(9)
SYLLABLES = ["an", "the", "ing", "or", "st", "re", "bel", "ti", "com", "un"]


def words(n):
    return ["".join(r.choice(SYLLABLES) for _ in range(r.randint(2, 4))) for _ in range(n)]


def text(n):
    return "\n".join(" ".join(words(8)) + "." for _ in range(n))


def test_planted_cases(corpus):
    item = " ".join(words(20)) + ". " + " ".join(words(6)) + "."
    passage = " ".join(words(60)) + "."
    base = text(12).split("\n")
    near = list(base)
    near[5] = "some other line"
    docs = {i: text(10) for i in range(1, 150)}
    docs |= {i: f"{text(5)} you vilething. {text(4)}" for i in range(200, 260)}  # toxic
    docs |= {300: text(20), 301: "", 302: None}
    docs[303] = docs[300]  # an exact copy
    docs |= {310: text(3) + "\n" + passage + "\n" + text(2), 311: text(2) + "\n" + passage + "\n" + text(4)}
    docs |= {320: " ".join(base), 321: " ".join(near), 330: f"{text(4)} {item} {text(4)}"}
    labels = [(i, 1, 0) for i in range(1, 150)] + [(i, 1, 1) for i in range(200, 255)]
    folder = scratch_path(corpus, "planted")
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs.items()]
    corpus.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    corpus.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    corpus.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    df, left = corpus.read.parquet(f"{folder}/documents.parquet"), {}
    columns = df.columns
    for name, step in corpus_pipeline.STAGES:
        step(corpus, df, folder).write.parquet(f"{folder}/{name}")
        df = corpus.read.parquet(f"{folder}/{name}")
        left[name] = {x["doc_id"] for x in df.collect()}
        if name != "packing":
            assert df.columns == columns
    clean = {*range(1, 150), 300, 301, 302, 310, 311, 320}
    assert left["toxicity"] == clean | {303, 321, 330}
    lined = {x["doc_id"]: x for x in corpus.read.parquet(f"{folder}/line_dedup").collect()}
    assert 303 not in lined and passage in lined[310]["text"] and passage not in lined[311]["text"]
    assert lined[311]["n_chars"] == len(lined[311]["text"]) and lined[302]["text"] is None
    assert left["near_dedup"] == clean | {330}
    assert left["decontamination"] == left["packing"] == clean


def test_run_equals_the_stages(corpus):
    """Where pieces are placed depends on tasks, so sequences are checked by themselves."""
    sf, folder = "/root/testdata/sf0.001", scratch_path(corpus, "by-hand")
    df = corpus.read.parquet(f"{sf}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        step(corpus, df, sf).write.parquet(f"{folder}/{name}")
        df = corpus.read.parquet(f"{folder}/{name}")
    cut = lambda rows: sorted((x["doc_id"], x["start"], x["length"], x["ids_crc32"], x["doc_tokens"]) for x in rows)
    rows = corpus_pipeline.run(corpus, sf).collect()
    assert rows and cut(rows) == cut(df.collect())
    sequences = {}
    for x in rows:
        sequences.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for pieces in sequences.values():
        ends = [0]
        for offset, length in sorted(pieces):
            assert offset == ends[-1] and length > 0
            ends.append(offset + length)
        assert ends[-1] <= 1024


def test_repeated_rows_leave_one(corpus):
    rows = [(1, "a b c", "x")] * 3 + [(1, "d e f", "x"), (2, None, "x"), (2, None, "x"), (None, "a b c", "x"), (None, "a b c", "x")]
    docs = corpus.createDataFrame(rows, "doc_id long, text string, version string")
    out = corpus_pipeline.drop_near_duplicates(corpus, docs, "")
    assert out.columns == docs.columns
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [*rows[2:5], *rows[6:]]))
