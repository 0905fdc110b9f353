"""Text repair against goldens and against plain Python over random text."""

import html
import random
import re
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hemeroteca.functions import fixed_values as fv
from hemeroteca.functions import text as tx
from hemeroteca.operators import cleaning


def column(spark, values, fn):
    """fn over a column of values, in order; one Spark job."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.select("i", fn(F.col("t")).alias("x")).orderBy("i").select("x").collect()]


SPLITS = {
    # text: (aggressive, conservative, final)
    "presidenteJavier Milei": ("presid e nte Javier Milei", "presidente Javier Milei", "presidente Javier Milei"),
    "artículo15": ("artículo 15", "artículo 15", "artículo 15"),
    "15artículos": ("15 artíc u los", "15 artículos", "15 artículos"),
    "COVID19": ("COVID 19", "COVID19", "COVID19"),
    "investigacionespor la": ("investigacion e spor la", "investigacionespor la", "investigacionespor la"),
    "delConsejo": ("del Consejo", "del Consejo", "del Consejo"),
    "importacionesyexportaciones": (
        "importacion e syex por taci o nes", "importaciones y exportaciones", "importaciones y exportaciones",
    ),
    "apoyoempresario": ("apoyoempr e sario", "apoyoempresario", "apoyoempresario"),
    "a b\n\nc": ("a b c", "a b c", "a b c"),
    "": ("", "", ""),
    None: (None, None, None),
}


@pytest.mark.parametrize("n,rules", list(enumerate(["aggressive", "conservative", "final"])))
def test_split_goldens(spark, n, rules):
    assert column(spark, SPLITS, lambda c: tx.unglue(c, rules)) == [v[n] for v in SPLITS.values()]


DAMAGE = {
    # damaged: (meant, table A, table B)
    "Ã³": ("ó", "ó", "ó"),
    "Ã­": ("í", "í", "í"),
    "Ã±": ("ñ", "ñ", "Ñ±"),
    "Ã‘": ("Ñ", "Í‘", "Ñ‘"),
    "Ã‰": ("É", "Í‰", "Ñ‰"),
    "Ã“": ("Ó", "Í“", "Ñ“"),
    "Ã¼": ("ü", "Í¼", "Ñ¼"),
    "Â°": ("°", "°", "°"),
    "â€˜xâ€™": ("‘x’", '"˜x"™', '"˜x"™'),
    "â€“": ("–", '"“', '"“'),
    "â€¦": ("…", '"¦', '"¦'),
    "sano": ("sano", "sano", "sano"),
    "Ã sola": ("Ã sola", "Í sola", "Ñ sola"),
    None: (None, None, None),
}


@pytest.mark.parametrize("n,table", list(enumerate(["repair", "A", "B"])))
def test_mojibake_goldens(spark, n, table):
    assert column(spark, DAMAGE, lambda c: tx.fix_mojibake(c, table)) == [v[n] for v in DAMAGE.values()]


def test_repair_undoes_the_damage_rule(spark):
    texts = ["".join(chr(n) for n in range(0xA0, 0x100)), "El niño comió «pingüinos» – ¿sí? — “no” … 5 €"]
    damaged = ["".join(tx._misread(c) if ord(c) > 0x7F else c for c in t) for t in texts]
    assert column(spark, damaged, lambda c: tx.fix_mojibake(c, "repair")) == texts


def test_entities_and_composition(spark):
    given_ = ["caf&eacute; é &copy &amp;lt;", "sin nada", "", None, "&#233;&#xe9;&nbsp;x"]
    want = ["café é © &lt;", "sin nada", "", None, "éé x"]
    assert column(spark, given_, tx.decode_and_compose) == want
    assert column(spark, given_, tx.decode_entities) == [v and html.unescape(v) for v in given_]
    assert column(spark, given_, tx.compose) == [v and unicodedata.normalize("NFC", v) for v in given_]


def test_suspects(spark):
    t = "anticonstitucionalmente pingüinosanticonstitucionalmente presidenteJavier ABc aBcDe ANTICONSTITUCIONALMENTE"
    assert column(spark, [t], tx.glued_suspects) == [
        ["anticonstitucionalmente", "anticonstitucionalmente", "presidenteJavier", "aBc"]
    ]


# --- plain restatements of the published patterns, for comparison ----------------------


def plain_squeeze(t):
    return re.sub(r"\s+", " ", t).strip()


def plain_unglue(t, rules):
    for pattern, replacement in fv.GLUE_RULES[rules]:
        t = re.sub(pattern.replace(r"\p{Nd}", r"\d"), re.sub(r"\$(\d)", r"\\\1", replacement), t)
    return plain_squeeze(t)


def plain_suspects(t):
    return re.findall(r"\b[a-záéíóúñ]{20,}\b", t.lower()) + re.findall(r"[a-záéíóúñ]+[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+", t)


def random_texts(n=4000, seed=7):
    rng = random.Random(seed)
    bits = (
        "a e o u y ni que por para con sin ser ir ver dar como pero ante porque sobre abc ñandú áé ü Ü Ñu Éx ABC 1 23 ٣ "
        "casa empresa importaciones"
    ).split() + [" ", "  ", "\n\n", " ", "\t", ".", "_", "-", "  ", "\x1c", "́"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("rules", sorted(fv.GLUE_RULES))
def test_split_equals_plain_python(spark, rules):
    texts = random_texts()
    got = column(spark, texts, lambda c: tx.unglue(c, rules))
    assert got == [plain_unglue(t, rules) for t in texts]


def test_suspects_equal_plain_python(spark):
    texts = random_texts(seed=11) + ["x" * 20, "x" * 19, "x" * 25 + "1", "_" + "x" * 25, "aBcDeFg"]
    assert column(spark, texts, tx.glued_suspects) == [plain_suspects(t) for t in texts]


def test_squeeze_knows_all_white_space(spark):
    every = [chr(n) for n in range(0x3100) if chr(n).isspace()] + [chr(0x200B), chr(0x180E), "x"]
    texts = [f"a{c}b" for c in every] + [f"{c} {c}a {c}" for c in every] + random_texts(500, 3)
    assert column(spark, texts, tx.squeeze) == [plain_squeeze(t) for t in texts]
    assert column(spark, every, tx.is_blank) == [t.strip() == "" for t in every]


words = st.text(alphabet="abceioruyñéÑÉABC 15\n .", max_size=60)
few = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(st.lists(words, min_size=1, max_size=150))
def test_splitting_only_adds_blanks(spark, texts):
    for rules in ("conservative", "final"):
        got = column(spark, texts, lambda c, r=rules: tx.unglue(c, r))
        assert ["".join(t.split()) for t in got] == ["".join(t.split()) for t in texts]


@few
@given(st.lists(words, min_size=1, max_size=150))
def test_squeeze_is_idempotent(spark, texts):
    once = column(spark, texts, tx.squeeze)
    assert column(spark, once, tx.squeeze) == once


def test_metadata_like(spark):
    texts = ["Publicado el 25 de noviembre de 2025", "Sin cifras", "1, 2, 3", "x" * 49 + "1", "x" * 48 + "1", "x²", "x½", ""]
    plain = [t.count(",") <= 1 and len(t) < 50 and any(c.isdigit() for c in t) for t in texts]
    assert column(spark, texts, tx.metadata_like) == plain
    assert column(spark, [None, "abc"], lambda c: tx.preview(c, 2, "N/A")) == ["N/A", "ab"]


def test_digit_class_holds_what_python_calls_digits(spark):
    import sys

    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(c, chr(c)) for c in points if c < 0x20000 or chr(c).isdigit()], "c int, s string")
    got = {r.c for r in rows.where(F.col("s").rlike(f"^{fv.DIGIT}$")).select("c").collect()}
    assert got == {c for c in points if chr(c).isdigit()}


def test_every_entity_without_python(spark):
    import html
    from html.entities import html5

    names = [n for name in html5 for n in (name, name.rstrip(";"), f"{name}x", f"{name.rstrip(';')}é;", f"{name[:-2]};")]
    texts = [f"a &{n} b" for n in names] + [f"&{name.rstrip(';')}&{name}" for name in html5]
    numbers = [*range(0x180), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0x1F600, 0x1FFFF, 0x10FFFD, 0x10FFFF, 0x110000, 10**7, 10**12]
    texts += [f"&#{n}{end}" for n in numbers for end in ("", ";", "z", ";;")] + [f"&#{x}000{n:x};" for n in numbers for x in "xX"]
    texts += ["&#;", "&#x;", "&", "&&amp;&", "&#xg;", "& amp;", "&\tlt;", "&amp;lt;", "&notit; &notin;", "&" + "a" * 40 + ";", "", None, "no reference"]
    texts += ["&#" + "0" * 50 + "65;", "&#x" + "f" * 200 + ";"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", tx.decode_entities(F.col("t")).alias("d"))
    got = {r.i: r.d for r in df.collect()}
    for i, t in enumerate(texts):
        assert got[i] == (None if t is None else html.unescape(t)), t
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("PythonUDF|EvalPython|ArrowEval|MapInArrow", plan)


def test_python_holds_few_texts_at_a_time():
    texts = pa.array([f"{i} café &eacute; " + "x" * 5000 for i in range(2000)] + [None, ""])
    tracemalloc.start()
    try:
        got = tx._unescape_nfc.func(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got[1999].as_py().startswith("1999 café é ") and got.to_pylist()[-2:] == [None, ""]
    assert len(got) == len(texts) and most < 3e6
    assert tx._nfc.func(pa.array([], pa.string())).to_pylist() == []


def test_cleaning_bounds_arrow_batches_unless_the_session_does(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.newSession()
    own.conf.unset(key)
    rows = own.createDataFrame([("café &amp; te",), (None,)], "body string")
    assert {r.body for r in cleaning.clean_articles(rows).collect()} == {"café & te", None}
    assert own.conf.get(key) == "4m"
    own.conf.set(key, "1m")
    cleaning.clean_articles(rows)
    assert own.conf.get(key) == "1m"
