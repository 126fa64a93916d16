"""Personal data: mentions, formats, awkward rows, and no original word left."""

import re

import pytest
from pyspark.sql import functions as F

from tierflow.llm.pii import leftovers, with_surrogates

PEOPLE = [
    (1, "Mr John Smith arrived. Smith left. John Smith called Mr. O'Brien and Mrs van Dyke. Smithson stays; O'Brien too."),
    (2, "Dr. Anna-Lena Müller met MR JOHN SMITH at 2001:db8:85a3:0:0:8a2e:370:7334; 12:30:45 is a time. Müller, SMITH"),
    (3, "Господин Иванов пришёл. Иванов ушёл. Herr Wolfgang Amadeus Maria von Stein; Stein"),
    (4, "no one here: \x01 \x01\x03 \x02 stays"),
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "doc_id bigint, text string")


def test_mentions_are_the_same_entity_and_no_word_is_left(people):
    after = with_surrogates(people, "key")
    text = {r.doc_id: r.text for r in after.collect()}
    words = lambda t: set(re.findall(r"[^\W\d_]+", t))
    assert not words(text[1]) & {"John", "Smith", "Brien", "Dyke"} and "Smithson stays" in text[1]
    assert not words(text[2]) & {"Anna", "Lena", "Müller", "JOHN", "SMITH"} and "12:30:45 is a time" in text[2]
    assert not words(text[3]) & {"Иванов", "Wolfgang", "Amadeus", "Maria", "Stein"} and " von " in text[3]
    first = text[1].split()
    given, surname = first[1], first[2]
    assert first[4] == surname and first[6:8] == [given, surname]
    # The same person in capitals elsewhere: gender, letter case and surrogate agree.
    loud = re.search(r"MR (\S+) (\S+) at", text[2]).groups()
    assert loud == (given.upper(), surname.upper())
    assert re.search(r"Dr\. \w+-\w+ \w+ met", text[2])
    assert re.search(r"at (?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4};", text[2]) and "2001:db8" not in text[2]
    assert re.search(r"^Господин [А-Яа-я]+ ", text[3])
    assert text[4] == PEOPLE[3][1]
    assert leftovers(people, after).count() == 0


def test_one_key_gives_one_result_and_rows_may_repeat(people):
    twice = people.unionByName(people).repartition(3)
    one = {r.text for r in with_surrogates(people, "key").collect()}
    rows = with_surrogates(twice, "key").collect()
    assert len(rows) == 2 * len(PEOPLE) and {r.text for r in rows} == one
    assert {r.text for r in with_surrogates(people, "other").collect()} != one


def test_clashing_names_long_texts_and_empty_tables(spark, people):
    body = " ".join(f"word{k}" for k in range(50_000))
    long = spark.createDataFrame([(1, f"{body} Mrs Ada Byron {body} Byron, a.b@mail.example", 5, "p")], "id int, text string, n_entities int, _parts string")
    row = with_surrogates(long, "key").first().asDict()
    assert row["_parts"] == "p" and row["n_entities"] == 5 and row["_n_entities"] == 4
    assert row["text"].startswith(body + " Mrs ") and "Byron" not in row["text"] and "a.b@" not in row["text"]
    assert with_surrogates(people.limit(0), "key").count() == 0
    nulls = with_surrogates(people.withColumn("text", F.lit(None).cast("string")), "key").collect()
    assert {(r.text, r.n_entities) for r in nulls} == {(None, 0)}


def test_a_small_private_range_overflows_into_the_larger_one(spark):
    """The originals hold 16,000 of 64,516 addresses; every surrogate differs from all of them."""
    rows = [(k, f"192.168.{k // 250 + 1}.{k % 250 + 1}") for k in range(16_000)]
    before = spark.createDataFrame(rows, "id int, text string")
    made = [r.text for r in with_surrogates(before, "key").collect()]
    assert len(set(made)) == len(rows) and not set(made) & {t for _, t in rows}
    assert all(t.startswith(("192.168.", "10.")) for t in made)
