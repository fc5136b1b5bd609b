import duckdb

from ledgerlake.llm.oracles import ORACLES
from ledgerlake.llm.quality import LineRules, base_counts, cleaned, judge_documents, line_fails

CLEAN = "This is a plain line of words that say something and end in a stop.\n"


def test_lines():
    rules = LineRules()
    assert line_fails("", rules) is None and line_fails(CLEAN, rules) is None
    assert line_fails("Home | News | About | Contact", rules) == "navigation"
    assert line_fails("BUY!! NOW!! CHEAP!!", rules) == "punctuation"
    assert line_fails("a$$$ b### c&&& d", rules) == "punctuation"
    assert line_fails("Please enable JavaScript to go on", rules) == "boilerplate"
    assert line_fails("spam " * 20, rules) == "boilerplate"


def test_prose_is_no_menu():
    rules = LineRules()
    for line in (
        "– Who is there?", "— Yes – I think so.", "• buy two apples", "· a short item", "Chapter 1 – The Beginning", "yes / no", "She – at last – said so",
        "A new design in the old town", "She kept a blog in French", "The catalog in question is a dialog in parts", "He pulled the thread more firmly",
    ):
        assert line_fails(line, rules) is None, line
    assert line_fails("Home » News » Sport", rules) == "navigation"
    assert line_fails("| Home | News | About |", rules) == "navigation"
    assert line_fails("Sign in or read more...", rules) == "boilerplate"


def test_dialogue_stays(spark):
    text = "\n".join(f"– Words{k} of{k} talk{k} go{k} on{k}" for k in range(12))
    row = judge_documents(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert row.kept and row.clean_text == text


def test_counts():
    text = "a b c\na b c\n\n \nx # <y>\na b c"
    assert base_counts(text.encode()) == {"n_words": 12, "word_chars": 14, "n_symbols": 3, "n_dup_lines": 2, "n_repeat_words": 9}
    assert base_counts("é ü\u00a0x".encode())["word_chars"] == 4  # a no-break space is no word end
    assert set(base_counts(b"").values()) == {0}


def test_documents(spark):
    half = CLEAN * 4 + "Menu | One | Two\n" * 2
    junk = CLEAN + "Menu | One | Two | Three | Four | Five\n" * 9
    rows = [(1, CLEAN * 3 + "End of it " * 2, "a"), (2, half.replace("plain", "long"), "b"), (3, junk, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    lines = "\n".join(" ".join(f"w{i}x{k}" for k in range(12)) + "." for i in range(6))
    docs = docs.union(spark.createDataFrame([(4, lines + "\nA | B | C", "d")], docs.schema))
    found = {r.doc_id: r for r in judge_documents(docs).collect()}
    assert found[4].kept and found[4].clean_text == lines and found[4].n_words == 77
    assert not found[3].kept
    assert not found[1].kept  # three equal lines repeat more than half of the words


def test_edges(edge_docs, no_docs):
    rows = judge_documents(edge_docs).collect()
    assert len(rows) == 12
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert r.n_words == 0 and r.base_failed and r.kept is False
    assert {r.clean_text for r in rows if r.doc_id == 1} == {None} and rows[0]["size"] == 7
    assert judge_documents(no_docs).count() == 0
    assert cleaned("a\nb", LineRules()) == ("a\nb", None)


def test_sql_states_the_same_rules(spark, tmp_path):
    """Dialogue, bullets, asides, menus, shouting and notices, alone and in prose, in the query and in its SQL."""
    prose = [f"Plain{k} words{k} that say{k} something{k} new{k} and end{k} in a stop{k}." for k in range(40)]
    lines = {
        "dialogue": [f"– Words{k} of{k} talk{k} go{k} on{k} here{k}" for k in range(12)],
        "aside": [f"She{k} – at last{k} – said{k} so{k} again{k} now{k}" for k in range(12)],
        "dashes": [f"Home{k} – News{k} – About{k} – Contact{k}" for k in range(20)],
        "bullets": [f"• buy{k} two{k} red{k} apples{k} today{k}" for k in range(20)],
        "bars": [f"| Home{k} | News{k} | About{k} |" for k in range(20)],
        "menus": [f"Home{k} » News{k} » Sport{k} of the day{k}" for k in range(20)],
        "long items": [f"one{k} two three four five{k} | six{k} seven eight nine ten{k} | eleven{k} twelve" for k in range(12)],
        "blog": [f"Kept{k} a blog in French{k} and read{k} the thread more{k} often" for k in range(12)],
        "log in": [f"Please{k} log in to see{k} what is new{k} here{k}, or read{k} on" for k in range(12)],
        "_log in_": [f"Please{k} log in_{k} ölog in{k} and sign in4 more{k} words{k} come" for k in range(12)],
        "shouting": [f"BUY{k}!! NOW{k}!! CHEAP{k}!! and{k} more{k}" for k in range(20)],
        "one word": [f"spam spam spam spam spam a{k} b{k} c{k} d{k} e{k} f{k}" for k in range(12)],
    }
    texts = ["\n".join(x) for x in lines.values()]
    for k, x in enumerate(lines.values()):
        texts += ["\n".join(prose[:n] + x[:m]) for n, m in ((3, 12), (9, 12), (20, 3), (k % 7, 5))]
    rows = list(enumerate(texts)) + [(1000, None), (1001, ""), (1002, " \n "), (1003, "\n".join(prose))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    known = {r[0]: r[1:] for r in con.execute(f"select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from ({ORACLES['op10_quality']})").fetchall()}
    found = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in judge_documents(docs).collect()}
    assert found == known
    assert 10 < sum(r[-1] for r in found.values()) < len(found) - 10
