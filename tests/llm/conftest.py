import random
import string

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, n int, sketch string, row string, ranges string, size double"


def documents(seed=0):
    """Small, but with everything that is awkward: nulls, empty and long texts, copies, shared passages, repeated rows."""
    r = random.Random(seed)
    vocab = ["".join(r.choices(string.ascii_lowercase, k=r.randint(1, 7))) for _ in range(4000)]
    text = lambda n: " ".join(r.choices(vocab, k=n))
    base, passage = text(200), text(40)
    texts = [text(r.randint(1, 120)) for _ in range(40)]
    texts += [base] * 25 + [base.upper(), base + " tail", "start " + base]
    words = base.split()
    for i in range(30):
        w = list(words)
        for _ in range(1 + i % 6):
            w[r.randrange(len(w))] = r.choice(vocab)
        texts.append(" ".join(w))
    texts += [f"{text(30)} {passage}\n{text(20)}" for _ in range(25)]
    texts += [None, "", "   \t\n", "a", "a b", "a b c", "A b C", "été 😀 ñ <|endoftext|> x", "$$$%%%" * 50, "la " * 3000, "x" * 5000, text(30_000)]
    rows = [(i * 3 + 1, t, r.choice(["en", None]), r.choice(["s1", "s1", "s1", "s2", "s3", "é", None]), len(t or ""), 1, 2, "q", "z", "y", 0.5) for i, t in enumerate(texts)]
    r.shuffle(rows)
    return rows


def save(spark, rows, schema, folder, name):
    spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("odd"))
    docs = documents()
    save(spark, docs, SCHEMA, d, "documents")
    save(spark, [(x[0], 1, int(x[0] % 5 == 0)) for x in docs] + [(None, 1, 1), (4, None, None), (4, 1, 1)], "doc_id long, quality int, toxic int", d, "labels")
    save(spark, [(1, "u", "<p>x</p>", 5), (2, None, None, 5), (2, None, None, 5), (3, "u", "", 5), (None, "u", "no tags", 5), (4, "u", "<html><body><nav><a>m</a></nav><article><p>" + "long text. " * 20000 + "</article>", 5)], "page_id long, url string, html string, n_chars int", d, "pages")
    r = random.Random(5)
    vec = lambda: [r.uniform(-1, 1) for _ in range(8)]
    same = vec()
    rows = [(i, vec() if i % 3 else same, 1) for i in range(400)]
    rows += [(500, None, 1), (600, [1.0, None] + [0.0] * 6, 1), (700, [float("nan")] + [0.0] * 7, 1), (800, [float("inf")] + [0.0] * 7, 1), (900, [], 1), (None, vec(), 1), (7, same, 2), (1000, [0.0] * 8, None)]
    save(spark, rows, "vec_id long, embedding array<float>, rank int", d, "embeddings")
    return d


@pytest.fixture(scope="session")
def none(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("none"))
    save(spark, [], SCHEMA, d, "documents")
    save(spark, [], "doc_id long, quality int, toxic int", d, "labels")
    save(spark, [], "page_id long, url string, html string", d, "pages")
    save(spark, [], "vec_id long, embedding array<float>, label int", d, "embeddings")
    return d


@pytest.fixture(scope="session")
def repeated(spark, tmp_path_factory, odd):
    """The same with rows that repeat, doc_ids that repeat with other texts, and doc_ids that are null."""
    d = str(tmp_path_factory.mktemp("repeated"))
    docs = documents(1)[:90]
    docs += docs[:10] + [(docs[3][0], *docs[4][1:]), (None, *docs[5][1:]), (None, *docs[5][1:])]
    save(spark, docs, SCHEMA, d, "documents")
    for name in ("labels", "pages", "embeddings"):
        spark.read.parquet(f"{odd}/{name}.parquet").write.parquet(f"{d}/{name}.parquet")
    return d
