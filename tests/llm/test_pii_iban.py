"""Account numbers followed by other words in capitals."""

from loanloom.llm import pii

NUMBERS = {
    "ES91 2100 0418 4502 0005 1332": " BIC CAIXESBB",
    "AT61 1904 3002 3457 3201": " BIC X",
    "SE45 5000 0000 0583 9825 7466": " NEXT",
    "BE68 5390 0754 7034": " BIC",
    "PL61 1090 1014 0000 0712 1981 2874": " SWIFT A",
    "GB82 WEST 1234 5698 7654 32": " BIC AB12",
    "NO93 8601 1117 947": " DNB",
    "DE89370400440532013000": " BIC COBA",
    "FR14 2004 1010 0505 0001 3M02 606": " A",
}


def test_iban_ends_where_its_number_ends(spark):
    texts = [f"IBAN {n}{after}" for n, after in NUMBERS.items()] + [f"IBAN {n}" for n in NUMBERS]
    texts += ["IBAN ES91 2100 0418 4502 0005 1333 BIC X", "IBAN GB82 WEST 1234 5698 7654 32X", "IBAN ES91 2100 0418 4502 0005"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "iban"] for r in pii.find(docs, ["doc_id"]).collect()}
    want = [[(5, 5 + len(n))] for n in [*NUMBERS, *NUMBERS]] + [[], [], []]
    assert [got[i] for i in range(len(texts))] == want


def test_iban_of_an_unlisted_country(spark):
    text = "IBAN DZ58 0002 1000 0111 3000 0005 70."
    spans = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), ["doc_id"]).first().spans
    assert [(s.start, s.end) for s in spans if s.kind == "iban"] == [(5, 37)]
