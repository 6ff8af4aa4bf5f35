from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmart.functions.text import LOCALES, fold, fold_text, register_txt, txt

CASES = [
    ('{"en_US": "Store", "es_ES": "Tienda"}', "Tienda"),
    ('{"es_419": "Tienda latina", "en_US": "Store"}', "Tienda latina"),
    ('{"en_US": "Store"}', "Store"),
    ('{"fr_FR": "Magasin"}', '{"fr_FR": "Magasin"}'),
    ('{"es_ES": null, "en_US": "Store"}', "Store"),
    ('{"es_ES": "", "en_US": "Store"}', ""),
    ("Texto plano", "Texto plano"),
    ("12", "12"),
    ('{"es_ES": "sin cerrar', '{"es_ES": "sin cerrar'),
    ('{"es_ES": "Ñandú \\"grande\\", 50%"}', 'Ñandú "grande", 50%'),
    (None, None),
]


def answers(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(txt("v")).collect()]


def test_txt_cases(spark):
    assert answers(spark, [v for v, _ in CASES]) == [want for _, want in CASES]


def test_txt_locales_are_a_parameter(spark):
    df = spark.createDataFrame([('{"en_US": "Store", "fr_FR": "Magasin"}',)], "v string")
    assert df.select(txt("v", ["fr_FR"])).first()[0] == "Magasin"


def test_txt_in_sql(spark):
    register_txt(spark)
    assert spark.sql("""SELECT txt('{"en_US": "Store"}')""").first()[0] == "Store"


def model(value):
    """What the display text should be, in plain Python."""
    try:
        parsed = json.loads(value)
    except ValueError:
        return value
    if isinstance(parsed, dict):
        for locale in LOCALES:
            if parsed.get(locale) is not None:
                return parsed[locale]
    return value


words = st.text(st.characters(codec="utf-8", exclude_categories=("C",)), max_size=8)
names = st.one_of(
    words,
    st.dictionaries(st.sampled_from([*LOCALES, "fr_FR"]), st.one_of(st.none(), words)).map(
        lambda d: json.dumps(d, ensure_ascii=False)
    ),
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(names, min_size=30, max_size=60))
def test_txt_equals_model(spark, values):
    assert answers(spark, values) == [model(v) for v in values]


def test_fold_matches_on_both_sides(spark):
    text = "  Categoría de Ñandúes "
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(fold("v")).first()[0] == fold_text(text) == "categoria de nandues"
    assert df.select(fold(F.lit("AÑO"))).first()[0] == "ano"
