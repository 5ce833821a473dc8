"""Golden vectors for the column-expression libraries."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warchest import functions as fx


def run(spark, vectors, build):
    """Evaluate ``build`` on every input row in one job and compare with the expected values."""
    width = len(vectors[0][0]) if isinstance(vectors[0][0], tuple) else 1
    names = [f"a{i}" for i in range(width)]
    schema = T.StructType([T.StructField("i", T.IntegerType())] + [T.StructField(n, T.StringType()) for n in names])
    rows = [(i, *(v[0] if width > 1 else (v[0],))) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = {r.i: r.out for r in df.select("i", build(*[F.col(n) for n in names]).alias("out")).collect()}
    want = {i: v[1] for i, v in enumerate(vectors)}
    bad = {vectors[i][0]: (got[i], want[i]) for i in want if got[i] != want[i]}
    assert not bad, bad


CAPITALS = [
    ("SMITH, JOHN JR", "Smith, John Jr"),
    ("O'BRIEN, PAT", "O'Brien, Pat"),
    ("MCDONALD, RONALD", "McDonald, Ronald"),
    ("AFL-CIO COPE COMMITTEE", "AFL-CIO Cope Committee"),
    ("DE LA CRUZ, ANA", "De la Cruz, Ana"),
    ("SMITH-JONES, MARY III", "Smith-Jones, Mary III"),
    ("GARZA, ELIGIO (KIKA)", "Garza, Eligio (Kika)"),
    ('SMITH, ""PAT"" "DE LA"', 'Smith, ""Pat"" "de la"'),
    ("ACME WIDGETS INC", "Acme Widgets INC"),
    ("INT'L UNION", "Int'l Union"),
    ("INTL ASSN OF ASS'N", "Intl Assn of Ass'n"),
    ("  acme   corp,\t inc. ", "Acme CORP, INC."),
    ("", ""), ("   ", ""), (None, None), (",", ""), ("SMITH,", "Smith"), ("SMITH,,", "Smith"),
    (",JOHN DE", ", John de"),
    ("SMITH,JOHN,JR.", "Smith, John,Jr."),
    ("THE COMMITTEE OF THE WHOLE", "The Committee of the Whole"),
    ("MEN'S 3RD A1B", "Men'S 3Rd A1B"),
    ("MC", "Mc"), ("MCX", "McX"), ("O'", "O'"), ("MACKEY", "Mackey"),
    ("JEAN-DE-LUC", "Jean-de-Luc"), ("DE-LA", "De-la"), ("X DE-LA CO-OP", "X de-la CO-Op"),
    ("O'NEIL-DE-LA", "O'Neil-De-La"), ("MCNEIL-DE", "McNeil-De"), ("A MCX-JR", "A McX-Jr"),
    ("(MCDONALD) -US-", "(McDonald) -US-"), ("A--B", "A--B"), ("- PAC", "- PAC"),
    ("PAC-MCX", "PAC-McX"), ("VII-X", "VII-X"), ("HENRY VIII (II)", "Henry VIII (II)"),
    ("A.MCX", "A.Mcx"), ("MÜLLER-ÖZ, JOSÉ", "Müller-Öz, José"), ("“PAC” «DE»", "“PAC” «de»"),
    ("ÉDE LA", "Éde la"), ("#1 USA!", "#1 USA!"),
]


def test_capitalize(spark):
    run(spark, CAPITALS, fx.capitalize_name)


def test_capitalize_is_idempotent(spark):
    done = [(v, v) for _, v in CAPITALS]
    run(spark, done, fx.capitalize_name)


def test_year(spark):
    run(spark, [
        ("01152024", 2024), ("1152024", 2024), ("01/15/2024", 2024), (" 1/5/2024 ", 2024),
        ("1/15/24", None), ("BADDATE", None), ("2024-01-15", None), ("", None), (None, None),
        ("20240115", 115), ("//112024", 2024), ("1/1/20 4", None), ("0115 202", 202),
        ("a/b/2_24", 224), ("01011_24", 124), ("0101__24", None),
    ], fx.transaction_year)


def test_month(spark):
    run(spark, [
        ("01152024", 1), ("1152024", 1), ("1/15/2024", 1), ("12/1/24", 12), ("99/1/1", 99),
        ("x/1/1", None), ("123/1/20", 12), ("1234/1/20", None), ("", None), (None, None), ("ab152024", None),
    ], fx.transaction_month)


ISO = [
    ("12/31/2024", "2024-12-31"), ("12312024", "2024-12-31"), ("1312024", "2024-01-31"),
    ("02/31/2024", "2024-02-31"), ("13/01/2024", None), ("01/01/1899", None),
    ("1/2/2100", "2100-01-02"), ("1/2/2101", None), ("1/32/2000", None), ("1/0/2000", None),
    ("1/2", None), ("1/2/3/4", None), ("x/2/2000", None), ("", None), (None, None),
]


def test_iso(spark):
    run(spark, ISO + [("2024-12-31", None)], fx.iso_date)
    keep = lambda c: fx.iso_date(c, keep_iso=True)
    run(spark, ISO + [("2024-12-31", "2024-12-31"), ("2024-13-31", None)], keep)


def test_calendar_date(spark):
    run(spark, [("02/31/2024", None), ("02292024", datetime.date(2024, 2, 29)), ("x", None)],
        fx.calendar_date)


def test_name_key(spark):
    run(spark, [
        ("PELOSI, NANCY P.", "PELOSI, NANCY"), ("BYRD, JR ROBERT C", "BYRD, ROBERT"),
        ("byrd jr, ", "BYRD JR,"), ("O'NEIL, T.P.", "ONEIL, TP"), ("SMITH, JR", "SMITH,"),
        ("SMITH, JR JR", "SMITH,"), ("ACME  CO. 'X'", "ACME CO X"), ("", ""), (None, ""),
        ("  ", ""), ("A,B,C D", "A, B,C"),
    ], fx.name_key)


def test_parse_name(spark):
    run(spark, [
        ("Payne, Donald M Jr", ("payne", "donald", "jr")), ("Payne, Donald, Jr.", ("payne", "donald,", "jr")),
        ("Payne, Donald,III", ("payne", "donald", "iii")), ("John Q Public", ("public", "john", "")),
        ("Cher", ("cher", "", "")), ("", ("", "", "")), (None, ("", "", "")), ("Lee,", ("lee", "", "")),
        ("Lee, \"Bob\" X", ("lee", "bob", "")), ("De La Cruz, Ana V", ("de la cruz", "ana", "v")),
    ], fx.parse_name)


@pytest.mark.parametrize("case", [0])
def test_score(spark, case):
    run(spark, [
        (("Smith, Robert", "Robert", "Smith", ""), 1.0),
        (("Smith, Robert Jr", "Robert", "Smith", ""), 1.0),
        (("Smith, Robert", "Robert", "Smith", "Jr"), 0.9),
        (("Smith, Robert Jr", "Robert", "Smith", "Jr."), 0.9),
        (("Smith, Bob", "Robert", "Smith", ""), 0.95),
        (("Smith, Bob", "Bobby", "Smith", None), 0.95),
        (("Smith, Robert", "Bob", "Smith", "II"), 0.85),
        (("Smith, Ruth", "Robert", "Smith", ""), 0.7),
        (("Smith, Ann", "Robert", "Smith", ""), 0.0),
        (("Smyth, Robert", "Robert", "Smith", ""), 0.0),
        (("Smith", "", "Smith", ""), 1.0),
        (("Smith, Al", "Alan", "Smith", ""), 0.95),
    ], fx.name_match_score)


def test_party_and_band(spark):
    df = spark.createDataFrame(
        [(0.85, "DEM", "DEM"), (0.7, "DEM", "DEM"), (1.0, "REP", "DEM"), (0.7, "REP", "DEM"),
         (0.9, None, "DEM"), (0.9, "DEM", ""), (1.0, "DEM", "DEM")],
        "s double, c string, t string")
    got = [tuple(r) for r in df.select(
        fx.party_adjusted(F.col("s"), F.col("c"), F.col("t")).alias("s"),
    ).select("s", fx.confidence_band(F.col("s"))).collect()]
    assert got == [(0.85 + 0.1, "high"), (0.7 + 0.1, "low"), (0.8, "medium"), (0.5, "low"),
                   (0.9, "medium"), (0.9, "medium"), (1.0, "high")]


def test_terms(spark):
    run(spark, [
        (("rep", "2021-01-03", "2023-01-03"), [2020, 2022]),
        (("sen", "1995-01-04", "2001-01-03"), [1994, 2000]),
        (("sen", "1975-01-04", "1981-01-03"), [1980]),
        (("sen", "1980-01-04", "1981-01-03"), [1980]),
        (("rep", "1977-01-04", "1981-01-03"), [1980]),
        (("rep", "1999-01-04", ""), [1998, 2000]),
        (("rep", "1999-01-04", None), [1998, 2000]),
        (("rep", "2025-01-04", "2031-01-03"), [2024, 2026]),
        (("rep", "1799-01-04", "1801-01-03"), []),
        (("rep", None, None), []),
    ], fx.term_cycles)
    run(spark, [(("1977-01-04", "1980-01-01"), True), (("1977-01-04", "1979-01-01"), False),
                (("1978-01-04", ""), True), (("2027-01-01", None), False), (("", ""), False),
                ((None, "1990-01-01"), False)], fx.term_in_range)


def test_codes(spark):
    run(spark, [("001", "001"), ("107", "107"), ("1", "012"), ("", "012"), (None, None)],
        fx.fold_category)
    run(spark, [("H8CA05035", True), ("X8CA05035", False), ("H8CA0503", False), (None, False)],
        fx.is_candidate_id)
    run(spark, [("C00401224", True), ("C0040122", False), ("H8CA05035", False), (None, False)],
        fx.is_committee_id)
