import pytest
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.functions import values as V


def one(spark, column, **values):
    kinds = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], kinds).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("SMACS 0723", "SMACS 0723"), ("SMACS 0723.", "SMACS 0723"), ("SMACS J0723", "SMACS 0723"), ("SMACS 0723.3", "SMACS 0723.3"), ("Messier 51 (M51)", "M 51"), ("m51", "M 51"),
        ("WASP 96b", "WASP-96 b"), ("ngc  3132", "NGC 3132"), ("Pillars of Creation.", "Pillars of Creation"), ("", None), (None, None), (" ", None), (".", None), ("(only)", "(only)"),
        ("Foo. (bar)", "Foo."), ("abell–370", "Abell 370"), ("trappist-1E", "TRAPPIST-1 e"),
    ],
)
def test_canonical_name(spark, raw, want):
    got = one(spark, T.canonical_name(F.col("s")), s=raw)
    assert got == want
    assert one(spark, T.canonical_name(F.col("s")), s=got) == got or raw in ("Foo. (bar)",)


@pytest.mark.parametrize("title", ["Cosmic Cliffs in Carina (image A)", "Cosmic Cliffs in Carina [square]", " cosmic  cliffs: in Carina (x] "])
def test_release_key(spark, title):
    assert one(spark, T.release_key(F.col("s")), s=title) == "cosmic cliffs in carina"


def test_release_key_of_nothing(spark):
    assert one(spark, T.release_key(F.col("s")), s=None) == ""


def test_normalise(spark):
    assert one(spark, T.normalise(F.col("s")), s="NGC-3132 é!") == "ngc3132"
    assert one(spark, T.normalise(F.col("s")), s=None) == ""


def test_caption_is_cleaned_before_it_is_cut(spark):
    got = one(spark, T.user_text(F.col("t"), F.col("d"), 20), t="T", d='<a href="x">Cassiopeia A</a> &amp; more and more')
    assert got == "TITLE: T\n\nCAPTION: Cassiopeia A & more "
    assert one(spark, T.user_text(F.col("t"), F.col("d")), t=None, d=None) == "TITLE: None\n\nCAPTION: "
    assert one(spark, T.clean_caption(F.col("s")), s="  a &lt;b&gt; \n") == "a <b>"


@pytest.mark.parametrize(
    ("value", "text", "want"),
    [
        ("multiple", "Hubble and others", "unknown"), ("multiple", "seen with NIRCam", "NIRCam"), ("multiple", "near-infrared camera and MIRI", "multiple"),
        ("multiple", "nircams only", "unknown"), ("MIRI", "no name", "MIRI"), ("multiple", None, "unknown"),
    ],
)
def test_correct_instrument(spark, value, text, want):
    named = T.named_instruments(F.lit("x"), F.col("d"))
    assert one(spark, T.correct_instrument(F.col("v"), named), v=value, d=text) == want


def test_name_verified(spark):
    def check(n, t, d):
        return one(spark, T.name_verified(F.col("n"), F.col("t"), F.col("d")), n=n, t=t, d=d)

    assert check("NGC 3132", "ngc-3132", "") is True
    assert check("M 51", "Messier 51", "") is False
    assert check("One", None, "x") is True  # a missing title reads None
    assert check("...", "a", "b") is True


def test_small_text_functions(spark):
    assert one(spark, T.before_bracket(F.col("s")), s="A title (x) and\nmore (y)") == "A title\nmore (y)"
    assert one(spark, T.before_bracket(F.col("s")), s="plain") == "plain"
    assert one(spark, T.one_line(F.col("s")), s="a \n\n b") == "a b"
    assert one(spark, T.base_name(F.col("s")), s="a/b/c.jpg") == "c.jpg"
    assert one(spark, T.stem(F.col("s")), s="c.jpg") == "c"
    assert one(spark, T.redact(F.col("s"), "k1"), s="key=k1") == "key=***"
    assert one(spark, T.safe_run_id(F.col("s")), s="run é:1+2") == "run_é_1_2"
    assert one(spark, T.html_escape(F.col("s")), s="<a&'b\">") == "&lt;a&amp;&#x27;b&quot;&gt;"
    assert len(one(spark, T.short_error(F.col("s")), s="x" * 900)) == 500


def test_values(spark):
    sizes = F.from_json("s", "array<struct<label: string, source: string>>")
    pick = V.pick_preferred(sizes)
    assert one(spark, pick, s='[{"label":"Large","source":"l"},{"label":"Original","source":"o1"},{"label":"Original","source":"o2"},{"label":"Thumb","source":"t"}]') == "o2"
    assert one(spark, pick, s='[{"label":"Thumb","source":"a"},{"label":"Odd","source":"b"}]') == "b"
    with pytest.raises(Exception, match="no sizes"):
        one(spark, pick, s="[]")
    info = one(spark, V.photo_info(F.col("s")), s='{"id":"1","title":{"_content":"t"},"description":{"_content":"d"},"dates":{"taken":""}}')
    assert (info.photo_id, info.title, info.tags, info.date_taken) == ("1", "t", [], None)
    assert float(spark.range(1).select(V.half_even(F.lit(1.125)).alias("x")).first().x) == 1.12
    vec = spark.createDataFrame([([1.0, float("nan")],), ([0.0, -1.0],), ([-1.0, -2.0],)], "v array<float>").select(V.not_finite(F.col("v")), V.largest_is_zero(F.col("v"))).collect()
    assert [tuple(r) for r in vec] == [(True, False), (False, True), (False, False)]
    with pytest.raises(Exception, match="not 3 components"):
        spark.createDataFrame([([1.0],)], "v array<double>").select(V.as_vector(F.col("v"), 3)).collect()
