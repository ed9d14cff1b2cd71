import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from pelagia import config
from pelagia.functions import geo, text


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "make, want",
    [
        (lambda: text.name_key(F.lit("Kali (LB)")), "KALI"),
        (lambda: text.name_key(F.lit(None).cast("string")), ""),
        (lambda: text.digits(F.lit("CB-8165")), "8165"),
        (lambda: text.digits(F.lit("SUST.")), ""),
        (lambda: text.folded(F.lit("  San  Vicénte ñ ")), "san vicente n"),
        (lambda: text.skeleton(F.lit("Aysén ñ")), "ays?n ?"),
        (lambda: text.vessel_name(F.lit("Pía - Kata")), "PIA KATA"),
        (lambda: text.ordinal_suffix(F.lit("ROCIO III")), 3),
        (lambda: text.ordinal_suffix(F.lit("ROCIO 12")), 12),
        (lambda: text.ordinal_suffix(F.lit("DANIELA ANDREA")), None),
        (lambda: text.suffixes_agree(F.lit("ROCIO I"), F.lit("ROCIO III")), False),
        (lambda: text.suffixes_agree(F.lit("ROCIO"), F.lit("ROCIO III")), True),
        (lambda: text.number_with_unit(F.lit("-29.23520°"), "°"), -29.2352),
        (lambda: text.number_with_unit(F.lit("abc kt"), "kt"), None),
        (lambda: text.port_title(F.lit("o'higgins san-vicente")), "O'Higgins San-Vicente"),
        (lambda: text.strip_tags(F.lit("<td> a&nbsp;<b>b</b></td>")), "a b"),
        (lambda: text.hex_to_code(F.lit(" 1F ")), 26),
        (lambda: text.hex_to_code(F.lit("12G")), None),
        (lambda: text.hex_to_code(text.code_to_hex(F.lit(940947))), 940947),
        (lambda: text.encode_gears(text.decode_gears(F.lit("B:2,1|junk|A:3"))), "A:3|B:1,2"),
        (lambda: text.only_gear(text.decode_gears(F.lit("A:3|B:3")), "3"), True),
        (lambda: text.only_gear(text.decode_gears(F.lit("A:3|B:1")), "3"), False),
        (lambda: text.first_code(F.lit("region de atacama"), [("tarapaca", 1), ("atacama", 3)]), 3),
        (lambda: text.search_variants(F.lit("Olivarez")), ["Olivarez", "olivarez", "oliva"]),
            (lambda: text.search_variants(F.lit("Patiño")), ["Patiño", "patino", "pati", "patin"]),
            (lambda: text.search_variants(F.lit("Ñu")), []),
            (lambda: text.strip_accents(F.lit("ŞǍḝÉﾀＡ")), "SAeÉ"[:3] + "EﾀA"),
        (lambda: geo.circular_delta(F.lit(1.0), F.lit(359.0)), 2.0),
        (lambda: geo.circular_delta(F.lit(359.0), F.lit(1.0)), -2.0),
        (lambda: geo.scaled_round(F.lit(2.5), 0), 2.0),
    ],
)
def test_scalar(spark, make, want):
    assert one(spark, make()) == want


@pytest.mark.parametrize("raw, code, name", [("940947 - DON BENITO II", "940947", "DON BENITO II"), ("601599 - PIA - KATA", "601599", "PIA - KATA"), ("600000 -", "600000", None), ("junk", None, None)])
def test_split_code(spark, raw, code, name):
    a, b = text.split_code(F.lit(raw))
    assert (one(spark, a), one(spark, b)) == (code, name)


def test_split_person(spark):
    assert tuple(one(spark, text.split_person(F.lit(" Soto  Diaz Ana Maria ")))) == ("Soto", "Diaz", "Ana Maria")
    assert tuple(one(spark, text.split_person(F.lit("Soto")))) == ("Soto", "", "") and tuple(one(spark, text.split_person(F.lit("")))) == ("", "", "")



def test_distances(spark):
    quarter = one(spark, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)))
    assert quarter == pytest.approx(6371.0 * math.pi / 2)
    assert one(spark, geo.sexagesimal(F.lit(273000))) == pytest.approx(-27.5)


def test_moon(spark):
    at = lambda s: one(spark, geo.moon_illumination(F.to_timestamp(F.lit(s))))
    assert at("2000-01-06 18:14:00") == pytest.approx(0, abs=1e-9)
    assert at("2000-01-21 12:36:00") == pytest.approx(1, abs=1e-3)
    assert at(None) is None


def test_regions():
    chile = config.region("chile")
    assert chile.bbox == (-56.6, -17.5, -76.5, -66.0)
    assert len(chile.landing_names) == 15
    assert [p.name for p in config.region("atacama").ports][-1] == "Chañaral de Aceituno"
    assert "Chañaral de Aceituno" not in [n for n, _, _ in config.region("atacama").points]
    with pytest.raises(ValueError):
        config.region("nowhere")


def test_names_and_ranges():
    assert config.scoped("x", "backup", "all") == "x_backup_all_species"
    assert config.range_tag() == "2019_2024"
    assert config.overlap((config.START, config.END), (config.END, config.END)) == (config.END, config.END)


def test_accents_and_compatibility_forms_against_unicode(spark):
    words = ["Ñuñoa ﬁsh", "Ⅳ Región", "ﬃ ½ … №", "Ǆ ĳ", "ＣＡＬＤＥＲＡ", "Nº 1ª", "a\u00a0b", "Ḟ ẞ ß Ø", "е́ Ж й ά", "", None, "plain", "①⑳", "⑴ ㏒"]
    got = [r[0] for r in spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, s string").orderBy("i").select(text.strip_accents(F.col("s"))).collect()]
    want = [None if w is None else "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c)) for w in words]
    assert got == want
