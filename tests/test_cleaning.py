import pytest
from pyspark.sql import functions as F

from recolith.functions import cleaning as cl

NAMES = {
    "Amazon Web Services, Inc.": ("amazon web services inc", "amazon web services"),
    "Microsoft Corporation": ("microsoft corp", "microsoft"),
    "Alphabet Google LLC": ("alphabet google llc", "alphabet google"),
    "Tata Consultancy Services Pvt. Ltd.": ("tata consultancy services pvt ltd", "tata consultancy services"),
    "Reliance Industries Private Limited": ("reliance industries pvt ltd", "reliance industries"),
    "Société Générale SA": ("societe generale sa", "societe generale"),
    "L'Oréal S.A.S.": ("loreal sas", "loreal"),
    "Carrefour Hypermarché EURL": ("carrefour hypermarche eurl", "carrefour hypermarche"),
    "Café de Flore SNC": ("cafe de flore snc", "cafe de flore"),
    "Ben & Jerry's, Inc.": ("ben and jerrys inc", "ben and jerrys"),
    "Wal-Mart Stores": ("walmart stores", "walmart stores"),
    "Acme Robotics Incorporated & Co.": ("acme robotics inc and co", "acme robotics"),
    "Société Anonyme France SARL": ("sa france sarl", "france"),
    "The": ("the", "the"),
    "": ("", ""),
    None: ("", ""),
}
ADDRESSES = {
    "29 Boulevard Haussmann, 75009 Paris": "29 blvd haussmann 75009 paris",
    "14 Rue Royale, 75008 Paris": "14 rue royale 75008 paris",
    "12 Main St, West Virginia": "12 main st west va",
    "410 Terry Ave N, Suite 500, Seattle, Washington 98109": "410 terry ave n ste 500 seattle wa 98109",
    None: "",
}
COUNTRIES = {"US": "US", "United States": "US", "IN": "IN", "India": "IN", "FR": "FR", "France": "FR", "DE": "DE", " jp ": "JP", None: "", "  ": ""}


def column(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in rows.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_names(spark):
    assert column(spark, NAMES, cl.clean_name) == [v[0] for v in NAMES.values()]
    assert column(spark, NAMES, cl.core_name) == [v[1] for v in NAMES.values()]


def test_cleaning_twice_changes_nothing(spark):
    once = column(spark, NAMES, cl.clean_name)
    assert column(spark, once, cl.clean_name) == once


def test_addresses(spark):
    assert column(spark, ADDRESSES, cl.clean_address) == list(ADDRESSES.values())


def test_countries(spark):
    assert column(spark, COUNTRIES, cl.clean_country) == list(COUNTRIES.values())


@pytest.mark.parametrize(("text", "plain"), [("éàüñ", "eaun"), ("é", "e"), ("ﬁn", "fin"), ("ß", "ß"), ("Ａ", "A")])
def test_accents(spark, text, plain):
    assert column(spark, [text], cl.strip_accents) == [plain]


def test_index_norm(spark):
    df = spark.createDataFrame([("Acme & Sons Ltd Inc", "12345 Rd 678901", "usa"), ("Café", "1234567", None)], "n string, a string, c string")
    out = df.select(*[c.alias(k) for k, c in cl.index_norm(F.col("n"), F.col("a"), F.col("c")).items()]).collect()
    assert tuple(out[0]) == ("US", "acme and sons", "acme", "12345")
    assert tuple(out[1]) == ("", "caf ", "", "") or tuple(out[1]) == ("", "caf", "", "")


def test_frame_without_country(spark):
    df = spark.createDataFrame([("S1-1", "A Inc", "1 Rd")], "entity_id string, business_name string, business_address string")
    assert "clean_country" not in cl.clean_records(df).columns
