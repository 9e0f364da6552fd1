import random

import pytest

from wickwork.llm import decontaminate
from wickwork.llm.common import lower_words

ITEMS = "item_id bigint, text string"


def brute(texts, items, window=10):
    out = {}
    for k, text in enumerate(texts):
        document, hit, ids = lower_words(text), set(), set()
        for item_id, item in items:
            words = lower_words(item)
            size = min(window, len(words))
            keys = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
            for i in range(len(document) - size + 1):
                if size and tuple(document[i : i + size]) in keys:
                    hit |= set(range(i, i + size))
                    if item_id is not None:
                        ids.add(str(item_id))
        out[k] = (len(document), sorted(hit), sorted(ids))
    return out


def got(df):
    return {
        r["doc_id"]: (r["n_words"], [w for h in r["hits"] for w in range(h["first"], h["last"])], r["item_ids"]) for r in df.collect()
    }


@pytest.fixture
def data(prose):
    rng = random.Random(8)
    items = [(k, prose(100 + k, rng.choice([2, 5, 9, 10, 11, 30]), 6)) for k in range(12)]
    items += [(3, items[0][1]), (None, prose(77, 12, 5)), (50, ""), (51, None), (9, "Straße, W1!")]
    texts = [prose(k, rng.randrange(0, 80), 6) for k in range(40)]
    texts += [f"Start. {items[5][1].upper().replace(' ', ', ')}; end.", None, "", "straße w1 STRASSE W1", " ".join(items[5][1] for _ in range(500))]
    return texts, items


@pytest.mark.parametrize("group_bytes", [1 << 20, 100])
def test_hits_match_brute_force(spark, docs, data, group_bytes):
    texts, items = data
    df = decontaminate.find_items(docs(texts), spark.createDataFrame(items, ITEMS), group_bytes=group_bytes)
    assert got(df) == brute(texts, items)


def test_spans_are_places_of_the_original(spark, docs):
    items = [(1, "one two three four five six seven eight nine ten")]
    text = "Ça — ONE, two three; four five six\nseven eight (nine) Ten! más"
    row = decontaminate.find_items(docs([text]), spark.createDataFrame(items, ITEMS)).first()
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == ["ONE, two three; four five six\nseven eight (nine) Ten"]


def test_empty_tables_and_clashing_names(spark, docs, data, clashing):
    texts, items = data
    none = spark.createDataFrame([], ITEMS)
    assert all(v[1:] == ([], []) for v in got(decontaminate.find_items(docs(texts), none)).values())
    assert decontaminate.find_items(docs([]), spark.createDataFrame(items, ITEMS)).count() == 0
    df = clashing(docs(texts + texts[:3]), "hits", "item_ids", "n_words", "spans", "row")
    assert decontaminate.find_items(df, spark.createDataFrame(items, ITEMS)).count() == len(texts) + 3
    clean = decontaminate.drop_contaminated(df, spark.createDataFrame(items, ITEMS))
    expected = [k for k, v in brute(texts + texts[:3], items).items() if not v[1]]
    assert clean.columns == df.columns and sorted(r["doc_id"] for r in clean.collect()) == expected
