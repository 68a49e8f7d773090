"""Parts of benchmark passages."""
import random

from leadrank.llm import decontaminate

from .test_operators import edited

LEAST = decontaminate.SHORT + decontaminate.STEP - 1


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_every_run_of_the_stated_length_is_found(spark, docs_of):
    items = [(n, words(n, size)) for n, size in enumerate((15, 39, 59, 120))]
    texts, want = [], []
    for n, item in items:
        for at in range(0, len(item) - LEAST + 1):
            texts.append(f"{words(1000 + at, 20)} zz {item[at:at + LEAST]} zz {words(2000 + at, 20)}")
            want.append((len(texts) - 1, n))
    docs = docs_of([*enumerate(texts), (-1, words(7, 300)), (-2, items[1][1][40:75])])
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == want and len(want) > 500
    assert all(LEAST + 2 * 150 > r.end - r.start >= 48 for r in found)
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == [-2, -1]


def test_a_whole_item_is_better_than_its_parts(spark, docs_of):
    item = words(5, 30)
    text = edited(item, 3, random.Random(1))
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    (row,) = decontaminate.contaminated(docs_of([(1, f"{words(8, 9)} {text} {words(9, 9)}")]), bench).collect()
    assert row.end - row.start == len(item) and 0 < row.edits <= 3
