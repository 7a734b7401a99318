import random

from sheafwork.llm.repeated_lines import bitmap_profile, document_lines, numbered_documents, repeated_lines, spelling_bitmaps, without_repeated_lines

SCHEMA = "cik string, doc string, item_name string, text string, line_no string"


def norm(line):
    return " ".join(line.replace("\r", " ").replace("\t", " ").split(" ")).strip().lower() if line.strip(" \t\r") else ""


def brute(rows, least):
    docs, places = {}, set()
    for cik, doc, part, text, _ in set(rows):
        for n, line in enumerate((text or "").split("\n"), 1) if text is not None else []:
            key = " ".join(line.lower().split())
            if key:
                src = None if cik is None else cik.lstrip("0") or "0"
                docs.setdefault((src, key), set()).add(doc)
                places.add((cik, src, doc, part, n, key))
    return {(doc, part, n) for cik, src, doc, part, n, key in places if len(docs[src, key]) >= least}


def test_equal_to_brute_force(spark):
    rng = random.Random(5)
    lines = ["Legal notice", "legal  NOTICE ", "\tLegal notice", "", "  ", "share this", "unique", "a b"]
    rows = [(rng.choice(["7", "07", "8", None]), f"d{i}", part, "\n".join([*[rng.choice(lines) for _ in range(rng.randint(0, 6))], f"own line {i}"]), "clash") for i in range(40) for part in ("item_6", "item_7")]
    rows += rows[:3] + [("7", "dn", "item_6", None, "x"), ("7", "de", "item_6", "", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = repeated_lines(df, "cik", "doc", min_documents=4)
    assert {(r.doc, r["part"] if "part" in r else r.item_name, r.line_no) for r in found.select("doc", "item_name", "line_no").collect()} == brute(rows, 4)
    cleaned = {(r.doc, r.item_name): r for r in without_repeated_lines(df, "cik", "doc").collect()}
    assert cleaned["dn", "item_6"].text is None and cleaned["de", "item_6"].text == ""
    gone = brute(rows, 4)
    for _, doc, part, text, _ in rows[:80]:
        kept = [line for n, line in enumerate(text.split("\n"), 1) if (doc, part, n) not in gone]
        assert cleaned[doc, part].text == "\n".join(kept)


def test_hot_source_and_line(spark):
    rows = [("1", f"d{i}", "item_6", "same line\nown %d" % i, None) for i in range(2000)] + [("2", "x", "item_6", "same line", None)]
    found = repeated_lines(spark.createDataFrame(rows, SCHEMA), "cik", "doc").collect()
    assert len(found) == 2000 and {r.n_documents for r in found} == {2000}


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repeated_lines(empty, "cik", "doc").count() == 0 and without_repeated_lines(empty, "cik", "doc").count() == 0


def test_documents_of_one_name_keep_to_their_source(spark):
    rows = [("A", f"d{i}", "item_6", f"own {i}\nnotice", None) for i in range(5)] + [("B", "d0", "item_6", "first\nunique", None)]
    cleaned = {(r.cik, r.doc): r.text for r in without_repeated_lines(spark.createDataFrame(rows, SCHEMA), "cik", "doc").collect()}
    assert cleaned["A", "d0"] == "own 0" and cleaned["B", "d0"] == "first\nunique"


def test_texts_of_one_document_keep_their_own_lines(spark):
    rows = [("A", f"d{i}", "item_6", f"own {i}\nnotice", "x") for i in range(4)] + [("A", "d0", "item_6", "other\nunique", "y")] + [("A", "d1", "item_6", "own 1\nnotice", "x")]
    cleaned = sorted((r.doc, r.text, r.n_removed) for r in without_repeated_lines(spark.createDataFrame(rows, SCHEMA), "cik", "doc").collect())
    assert cleaned[:2] == [("d0", "other\nunique", 0), ("d0", "own 0", 1)]
    assert cleaned[2:4] == [("d1", "own 1", 1)] * 2  # repeated rows stay


def test_numbers_are_dense_and_containers_hold_many_bits(spark):
    rows = [("hot", f"d{i}", "item_6", "same\nSAME  \nown %d" % i, None) for i in range(3000)] + [(None, f"e{i}", "item_6", "same", None) for i in range(70)]
    df = spark.createDataFrame(rows, SCHEMA)
    numbers = numbered_documents(df, "cik", "doc").collect()
    assert sorted(r.number for r in numbers if r.src == "hot") == list(range(3000))
    assert sorted(r.number for r in numbers if r.src is None) == list(range(70))
    lines = document_lines(df, "cik", "doc", "item_name", "text")
    of_hot = spelling_bitmaps(lines).filter("src = 'hot'").selectExpr("spelling", "bit_count(bits) AS n").collect()
    by = {}
    for r in of_hot:
        by.setdefault(r.spelling, []).append(r.n)
    full = [v for v in by.values() if len(v) > 1]
    assert len(full) == 2 and all(sum(v) == 3000 and len(v) == 47 for v in full)  # two spellings, 64 documents a container
    profile = {r.src: r for r in bitmap_profile(lines).collect()}
    assert profile["hot"].n_lines == 3001 and profile["hot"].n_bits == 6000 and profile[None].bits_per_container == 35


def test_clashing_names_survive(spark):
    df = spark.createDataFrame([("A", "d", "item_6", "x", "1", 7, 8)], "cik string, doc string, item_name string, text string, src string, n_removed int, _drop int")
    assert without_repeated_lines(df, "cik", "doc").first().asDict() == {"cik": "A", "doc": "d", "item_name": "item_6", "text": "x", "src": "1", "n_removed": 7, "_drop": 8, "n_removed_2": 0}
