"""The SQL twin where lines are removed and documents rejected."""

import duckdb

from scread.llm import line_rules


def test_twin_with_depleted_documents(spark):
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    rows = []
    for i in range(60):
        # the host's boiler plate is 20 words; with 50 of its own a document loses over a quarter, with 80 a fifth
        own = 50 if i % 3 else 80
        shared = "Boiler  plate " + words("b", 18) if i % 2 else words(f"s{i}", 20)
        rows.append((i, f"{words(i, own)}\n{shared}", "h1" if i < 40 else None))
    rows += [(100 + i, words("few", 60), "h2") for i in range(5)] + [(200 + i, words("many", 60), "h2") for i in range(6)]
    rows += [(300, None, "h1"), (301, "", None), (302, "boiler plate " + words("b", 18).upper(), "h1"), (5, rows[5][1], "h1"), (303, rows[5][1], "h1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.register("frame", df.toPandas())
    con.execute("create table documents as select doc_id::BIGINT as doc_id, text, source from frame")
    got = line_rules.line_rules(df)
    cols = sorted(got.columns)
    want = con.execute(f"select {', '.join(cols)} from ({line_rules.OP2_SQL})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(cols).collect()))) == sorted(map(str, want))
    seen = {r["doc_id"]: r for r in got.collect()}
    assert not seen[1]["kept"] and not seen[1]["base_failed"] and seen[1]["n_removed_words"] == 20  # 20 of 70 words
    assert seen[3]["kept"] and seen[3]["n_removed_words"] == 20 and seen[2]["kept"] and seen[2]["n_removed_words"] == 0
    assert seen[100]["kept"] and not seen[200]["kept"]  # five documents are a handful, six are not
