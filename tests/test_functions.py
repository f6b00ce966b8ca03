"""Expressions against values worked out by hand."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tremor.functions import messages as msg
from tremor.functions import places, text


def values(spark, expression, inputs, kind="STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i INT, v {kind}")
    return [row.r for row in df.select("i", expression.alias("r")).orderBy("i").collect()]


def v():
    return F.col("v")


def test_capitalized_starts_words_after_any_punctuation(spark):
    given = ["ankara/çankaya", "İSTANBUL, TR", "o'neil bay-x", "3rd street", "", None, "  iki  boşluk"]
    assert values(spark, text.capitalized(v()), given) == [
        "Ankara/Çankaya", "İstanbul, Tr", "O'Neil Bay-X", "3rd Street", "", None, "  Iki  Boşluk",
    ]


def test_location_forms(spark):
    given = ["Malatya", "Malatya, TR", "Malatya ,TR", ",x", None]
    assert values(spark, places.location_key(v()), given) == ["MALATYA", "MALATYA", "MALATYA ", "", None]
    assert values(spark, places.location_label(v()), ["ankara/merkez, tr", None]) == ["Ankara/Merkez", None]
    assert values(spark, places.upper_case(v(), turkish=True), ["izmir", "ısparta"]) == ["İZMİR", "ISPARTA"]
    assert values(spark, places.upper_case(v()), ["izmir"]) == ["IZMIR"]


def test_decimal_comma(spark):
    assert values(spark, text.decimal_comma(v()), ["2,55", "7", None]) == [2.55, 7.0, None]
    assert values(spark, text.decimal_comma(v(), lenient=True), ["x", "1,5"]) == [None, 1.5]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, text.decimal_comma(v()), ["x"])
    assert values(spark, text.with_decimal_comma(v(), 3), [2.5, -0.0704], "DOUBLE") == ["2,500", "-0,070"]


def test_line_pieces_keep_empties_and_fail_when_short(spark):
    assert values(spark, text.part(v(), ";", 1), ["a;b;c", "a;;c"]) == ["b", ""]
    assert values(spark, text.parts(v(), "**"), ["a**b**"]) == [["a", "b", ""]]
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        values(spark, text.part(v(), ";", 3), ["a;b"])


def test_words_follow_lines(spark):
    story = "bir  iki\nüç\r\ndört\rbeş\n"
    expected = [word for line in ["bir  iki", "üç", "dört", "beş", ""] for word in line.split(" ")]
    assert values(spark, text.words_of_lines(v()), [story]) == [expected]


def test_characters_of_upper_cased_words(spark):
    chars = [c for word in "Ayşe okula git".upper().split(" ") for c in word]
    df = spark.createDataFrame([("Ayşe okula git",)], "v STRING")
    words = df.select(F.explode(F.split(F.upper(v()), " ")).alias("w"))
    found = [r.c for r in words.select(F.explode(text.characters(F.col("w"))).alias("c")).collect()]
    assert sorted(found) == sorted(chars) and len(found) == 12


def test_words_of_single_characters(spark):
    """Splitting each character at blanks turns a blank into two empty words: 12 letters and 4 empties."""
    df = spark.createDataFrame([("Ayşe okula git",)], "v STRING")
    chars = df.select(F.explode(text.characters(v())).alias("c"))
    words = [r.w for r in chars.select(F.explode(F.split(F.upper("c"), " ")).alias("w")).collect()]
    assert len(words) == 16 and words.count("") == 4


def test_quotes(spark):
    assert values(spark, text.quotes_to_spaces(v()), ["Türkiye'de 'x'"]) == ["Türkiye de  x "]


SAMPLE = {"id": 1, "text": "#deprem Test", "lang": "tr", "place": None, "user": {"location": "Malatya"}, "geo": None}


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value STRING")


def test_messages_like_a_json_parser_with_dropped_failures(spark):
    good = dict(SAMPLE, id=2, place={"name": "Ankara", "country": "TR"})
    rows = [
        json.dumps(SAMPLE),
        json.dumps(good),
        json.dumps(dict(good, id=3, text=None)),
        json.dumps(dict(good, id=4))[:-2],
        '{"id":5,"text":"t","place":{"name":"X"},"us',
        "not json",
        "",
        '{"id":6,"text":"no place"}',
        json.dumps(dict(good, id=7, text='it\'s "quoted" \u00c7al\u0131\u015fma', user={"location": None})),
        json.dumps(dict(good, id=8, user=None)),
    ]
    df = lines(spark, rows)
    assert [r.id for r in msg.parsed_messages(df).orderBy("id").collect()] == list("123678")
    assert [r.id for r in msg.messages_with_place(df).orderBy("id").collect()] == list("2378")
    with_text = msg.messages_with_place(df, need_text=True).orderBy("id").collect()
    assert [(r.id, r.place) for r in with_text] == [("2", "Ankara"), ("7", "Ankara"), ("8", "Ankara")]
    assert with_text[1].text == 'it\'s "quoted" Çalışma' and with_text[1].location is None


def test_a_defect_in_one_field_spares_the_others(spark):
    rows = [
        '{"id":"m1","place":{"name":"Ankara"},"user":{"location":"Van"}}',
        '{"id":123456789012345678901234567890,"place":{"name":"Ankara"},"user":{"location":"Van"}}',
        '{"id":3,"place":{"name":"Ankara"},"user":"nobody"}',
        '{"id":4,"place":"somewhere","user":{"location":"Van"}}',
        '{"id":5,"place":{"name":"Ankara"},"user":{"location":"Van"},"coordinates":"none"}',
        '{"id":6,"coordinates":{"type":"Point","coordinates":[30.5,39.75]}}',
        '[1, 2]',
        '{"id":8,"place":{"name":"X"}',
    ]
    found = {r.id: (r.place, r.location, r.lon, r.lat) for r in msg.parsed_messages(lines(spark, rows)).collect()}
    assert found == {
        "m1": ("Ankara", "Van", None, None),
        "123456789012345678901234567890": ("Ankara", "Van", None, None),
        "3": ("Ankara", None, None, None),
        "4": (None, "Van", None, None),
        "5": ("Ankara", "Van", None, None),
        "6": (None, None, 30.5, 39.75),
    }


def test_subscribed_lines_stay_as_they_came(spark):
    inside = {"lang": "tr", "text": "x", "coordinates": {"coordinates": [30, 40]}}
    rows = [json.dumps(r) for r in (inside, dict(inside, lang="en"), dict(inside, coordinates=None, text="#deprem"))]
    kept = msg.subscribed(lines(spark, [*rows, "{"]), msg.subscription()).collect()
    assert [r.value for r in kept] == [rows[0], rows[2]]


def test_lines_keep_the_place_of_unknown_fields(spark):
    df = spark.createDataFrame([("a", None, "c")], "x STRING, y STRING, z STRING")
    assert df.select(text.line_of(";", "x", "y", "z")).first()[0] == "a;;c"
    assert values(spark, text.filled(text.part(v(), ";", 1)), ["a;;c", "a;b;c"]) == [None, "b"]


def test_each_line_is_parsed_once(spark):
    plan = msg.messages_with_place(lines(spark, ["{}"]), need_text=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_stored_location(spark):
    rows = [json.dumps(SAMPLE), '{"user":{"location":null}}', "{}", json.dumps(SAMPLE)[:-2], "no JSON", "", None, '{"user":"x"}']
    assert values(spark, msg.stored_location(v()), rows) == ["Malatya", *[None] * 7]


def test_subscription(spark):
    rows = [
        (1, "tr", 30.0, 40.0, "x"),  # in the box
        (2, "tr", 150.0, 40.0, "x #deprem"),  # by term
        (3, "tr", 150.0, 40.0, "x"),
        (4, "en", 30.0, 40.0, "#deprem"),
        (5, "tr", None, None, "#deprem"),
        (6, "tr", None, None, "x"),
        (7, "tr", -130.0, 50.0, "x"),  # on the edge
    ]
    df = spark.createDataFrame(rows, "id INT, lang STRING, lon DOUBLE, lat DOUBLE, text STRING")
    assert sorted(r.id for r in df.where(msg.subscription()).collect()) == [1, 2, 5, 7]


def test_tagged_lines(spark):
    pairs = [("deprem oldu", "Ankara"), ("iki\nsatır", "İzmir"), ("x", "a**b")]
    df = spark.createDataFrame(pairs, "text STRING, place STRING")
    built = df.select(msg.tagged_line(F.col("text"), F.col("place")).alias("value"))
    assert built.first().value == " mgnsmgns deprem oldu mgnsmgns Ankara**mrtaydn mgnsmgns "
    as_lines = built.select(F.explode(F.split("value", "\n")).alias("value"))
    assert sorted(r.location for r in msg.tagged_places(as_lines).collect()) == ["Ankara", "a", "b", "İzmir"]
    assert " Ankara" in {r.location for r in msg.tagged_places(as_lines, trim=False).collect()}
