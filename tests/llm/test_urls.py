"""The URL models against their SQL on more characters than any bound that once was there."""

import random

import pandas as pd

from millrace.llm.queries import QUERIES
from tests import oracle


def test_equals_sql_on_many_characters(spark, tmp_path):
    """Rare grams in 2^17 characters of both kinds; some decide about a URL without a rule."""
    r = random.Random(11)
    good, bad = ["news", "blog", "archiv", "wiki"], ["casino", "pills", "spam", "cheap"]
    rows = []
    for i in range(12000):
        own = good if i % 2 else bad
        path = "-".join(r.choices(own, k=3)) + f"{r.randrange(10**6)}"
        if r.random() < 0.02:
            path += "".join(r.choices("qxzjkw", k=5))
        host = ["shop.com/fr/", "shop.com/de/"][1 - i % 2] if i % 3 else "other.net/x/"
        rows.append((i, f"https://{host}{path}", "<p>"))
    pd.DataFrame(rows, columns=["page_id", "url", "html"]).to_parquet(f"{tmp_path}/pages.parquet")
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet')")
    for verdict, path in (("allow", "/fr/"), ("block", "/de/")):
        size = con.execute(f"SELECT sum(length(url)) FROM pages WHERE url LIKE '%com{path}%'").fetchone()[0]
        assert size - 8 * 4000 > 1 << 17, verdict
    query = QUERIES["op8_url_filter"]
    assert oracle.compare(con, query(spark, str(tmp_path)), query.sql) is None
