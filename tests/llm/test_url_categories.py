from textloom.llm import url_filters


def test_categories_of_a_domain_hold_apart(spark):
    listed = [("a.example", "spam", "add", "2024-01-01"), ("a.example", "adult", "add", "2024-01-01"), ("a.example", "phish", "add", "2024-02-01"), ("a.example", "spam", "remove", "2024-03-01")]
    entries = spark.createDataFrame(listed, "domain string, category string, action string, day string")
    rows = spark.createDataFrame([("http://a.example/", d) for d in ("2024-01-15", "2024-02-15", "2024-03-15")], "url string, fetch_time string")
    out = {r["fetch_time"][5:7]: r["matched"] for r in url_filters.evaluate(rows, entries).collect()}
    each = {k: ",".join(f"a.example:{c}" for c in v) for k, v in {"01": ("adult", "spam"), "02": ("adult", "phish", "spam"), "03": ("adult", "phish")}.items()}
    assert out == each
