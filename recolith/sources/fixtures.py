"""Sample tables: seven small files with known matches, for demonstrations and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recolith.sources.records import RECORD, TRUTH, publish, write_tsv

# The rows of the sample, fields separated by a bar.
TRAIN_1 = """
S1-00001|Amazon Web Services Inc.|410 Terry Ave N, Seattle, WA 98109|US
S1-00002|Microsoft Corporation|One Microsoft Way, Redmond, WA 98052|US
S1-00003|Alphabet Google LLC|1600 Amphitheatre Pkwy, Mountain View, CA 94043|US
S1-00004|Starbucks Coffee Company|2401 Utah Ave S, Seattle, WA 98134|US
S1-00005|Lone Star Lone Singleton LLC|123 Main St, Austin, TX 78701|US
S1-00006|Tata Consultancy Services Ltd|TCS House, Raveline St, Fort, Mumbai, Maharashtra 400001|IN
S1-00007|Infosys Technologies Limited|Electronics City, Hosur Road, Bengaluru, Karnataka 560100|IN
S1-00008|Reliance Industries Private Limited|Maker Chambers IV, Nariman Point, Mumbai 400021|IN
S1-00009|HDFC Bank Ltd.|HDFC Bank House, Senapati Bapat Marg, Lower Parel, Mumbai 400013|IN
S1-00010|Verma Sweets & Bakery Singleton|Opposite Bus Stand, Sector 14, Gurugram, Haryana 122001|IN
"""
TRAIN_2 = """
S2-00001|AWS Corp|410 Terry Avenue North, Seattle WA 98109|US
S2-00002|Microsoft Corp.|1 Microsoft Way, Redmond WA 98052|US
S2-00003|Google Inc|1600 Amphitheatre Parkway, Mountain View CA|US
S2-00004|TCS Pvt Ltd|TCS House Raveline Street Fort Mumbai 400001|IN
S2-00005|Infosys Ltd|Plot 44 Electronic City Hosur Rd Bangalore 560100|IN
S2-00006|Reliance Ind|Maker Chambers 4 Nariman Pt Mumbai 400021|IN
S2-00007|Unrelated Retail Shop|500 5th Ave New York NY 10036|US
S2-00008|Sharma General Store|Near Metro Station Gurgaon 122002|IN
"""
TRAIN_3 = """
S3-00001|Amazon Web Services|410 Terry Ave, Seattle, Washington|US
S3-00002|Starbucks Corp|2401 Utah Avenue South, Suite 800, Seattle WA 98134|US
S3-00003|HDFC Bank|Senapati Bapat Marg Lower Parel Mumbai 400013|IN
S3-00004|Tata Consultancy Serv|Raveline St Mumbai 400001|IN
S3-00005|Global Hardware Distributors|100 Industrial Pkwy Chicago IL 60601|US
S3-00006|Delhi Book Emporium|Connaught Place New Delhi 110001|IN
"""
TEST_1 = """
S1-10001|Société Générale SA|29 Boulevard Haussmann, 75009 Paris|FR
S1-10002|L'Oréal S.A.S.|14 Rue Royale, 75008 Paris|FR
S1-10003|Carrefour Hypermarché EURL|93 Avenue de Paris, 91300 Massy|FR
S1-10004|Café de Flore SNC|172 Boulevard Saint-Germain, 75006 Paris|FR
S1-10005|French Singleton Boutique|10 Rue du Faubourg Saint-Honoré, 75008 Paris|FR
S1-10006|Apple Computer Inc|One Apple Park Way, Cupertino, CA 95014|US
S1-10007|Tesla Motors Inc.|1 Tesla Road, Austin, TX 78725|US
S1-10008|Wipro Technologies Ltd|Doddakannelli, Sarjapur Road, Bengaluru 560035|IN
S1-10009|State Bank of India|State Bank Bhavan, Madame Cama Road, Nariman Point, Mumbai 400021|IN
S1-10010|US Singleton Florist|55 Blossom Way, Portland, OR 97201|US
"""
TEST_2 = """
S2-10001|Societe Generale|29 Bd Haussmann Paris 75009|FR
S2-10002|Loreal SAS|14 Rue Royale 75008 Paris|FR
S2-10003|Apple Inc.|1 Apple Park Way Cupertino CA 95014|US
S2-10004|Wipro Limited|Sarjapur Rd Bangalore 560035|IN
S2-10005|Unrelated Bistro|15 Rue de Rennes 75006 Paris|FR
"""
TEST_3 = """
S3-10001|SocGen Corporate|29 Boulevard Haussmann, Paris|FR
S3-10002|Carrefour Supermarché|93 Ave de Paris, Massy 91300|FR
S3-10003|Tesla Inc|1 Tesla Rd Austin TX 78725|US
S3-10004|SBI Bank|Madame Cama Rd Nariman Pt Mumbai 400021|IN
S3-10005|Non-Matching Bookstore|12 Rue Monge 75005 Paris|FR
"""
TRUTH_ROWS = """
S1-00001|S2-00001,S3-00001
S1-00002|S2-00002
S1-00003|S2-00003
S1-00004|S3-00002
S1-00005|
S1-00006|S2-00004,S3-00004
S1-00007|S2-00005
S1-00008|S2-00006
S1-00009|S3-00003
S1-00010|
"""

FILES = {
    "train_source1": TRAIN_1, "train_source2": TRAIN_2, "train_source3": TRAIN_3, "train_ground_truth": TRUTH_ROWS,
    "test_source1": TEST_1, "test_source2": TEST_2, "test_source3": TEST_3,
}


def sample(spark: SparkSession, name: str) -> DataFrame:
    """One sample table by file name."""
    rows = [tuple(line.split("|")) for line in FILES[name].strip().splitlines()]
    return spark.createDataFrame(rows, TRUTH if name == "train_ground_truth" else RECORD)


def write_samples(spark: SparkSession, folder: str) -> list[str]:
    """All seven tables as single tab-separated files."""
    paths = []
    for name in FILES:
        path = f"{folder}/{name}.tsv"
        write_tsv(sample(spark, name), path + ".parts", single=True)
        publish(spark, path + ".parts", path)
        paths.append(path)
    return paths
