"""IBANs with upper-case words or numbers behind them, and several keys after one hint."""

from listingflow.llm.pii import personal_data, redact


def test_ibans_end_where_their_country_says(spark):
    gb, de = "GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00"
    rows = [
        (1, f"{gb} BIC ABCDGB2L"), (2, "GB82WEST12345698765432 EUR 300"), (3, f"{gb} {de}"), (4, f"AB12 {gb} X1"),
        (5, "GB82WEST123456987654321"), (6, "NO93 8601 1117 947 NOK"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in personal_data(docs).collect()}
    own = {i: [s for s in found.split(",") if s.startswith("iban")] for i, found in spans.items()}
    assert own == {1: ["iban:0:27"], 2: ["iban:0:22"], 3: ["iban:0:27", "iban:28:55"], 4: ["iban:5:32"], 5: [], 6: ["iban:0:18"]}
    texts = {r.doc_id: r.text for r in redact(docs).collect()}
    assert texts[1] == "<iban> BIC ABCDGB2L" and texts[3] == "<iban> <iban>"


def test_several_keys_after_one_hint(spark):
    keys = ["0a" * 16, "1b" * 20, "2c" * 32]
    rows = [(1, "token: " + " ".join(keys)), (2, " ".join(keys) + " password"), (3, " ".join(keys)), (4, "token " + "x " * 30 + keys[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in personal_data(docs).collect()}
    assert spans == {1: "secret:7:39,secret:40:80,secret:81:145", 2: "secret:0:32,secret:33:73,secret:74:138", 3: "", 4: ""}
    assert {r.doc_id: r.text for r in redact(docs).collect()}[1] == "token: <secret> <secret> <secret>"
