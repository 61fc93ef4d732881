"""Shared lines against a plain count."""

from collections import defaultdict

from pyspark.sql import functions as F

from chattermark.llm.linededup import drop_shared_lines

BLANKS = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_chars=20, min_documents=3):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[line.strip(BLANKS).translate(UPPER)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(BLANKS).translate(UPPER)
            own = holders[key]
            if len(key) >= min_chars and len(own) >= min_documents and doc_id != max(own):
                continue
            kept.append(line)
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def found(df, **options):
    return sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in drop_shared_lines(df, **options).collect())


def test_same_as_plain(texts):
    shared = "This line stands in several documents"
    rows = [
        (1, f"{shared}\none\n{shared.upper()}"),
        (2, f"  {shared}\t\r\ntwo"),
        (3, f"{shared}\n{shared}\nthree"),
        (4, "short shared\nÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ"),
        (5, "short shared\nééééééééééééééééééé é"),
        (6, "short shared\nééééééééééééééééééé é\n ééééééééééééééééééé é"),
        (7, "ééééééééééééééééééé é"),
        (8, None),
        (9, ""),
        (10, "\n\n"),
        (11, "twice only, but long enough\n" + "x" * 100_000),
        (12, "twice only, but long enough"),
    ]
    assert found(texts(*rows)) == plain(rows)
    assert found(texts(*rows), min_chars=1, min_documents=2) == plain(rows, 1, 2)


def test_whole_table(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert found(documents) == plain(rows)


def test_repeated_ids_and_null_ids(texts):
    line = "a line that is long enough to count"
    # Two rows of id 1 are one document, rows without id together are another one.
    rows = texts((1, line), (1, line), (None, line), (None, f"{line}\nrest"))
    assert {r.n_dropped for r in drop_shared_lines(rows).collect()} == {0}
    rows = texts((1, line), (1, line), (None, f"{line}\nrest"), (2, line))
    got = sorted((r.doc_id or 0, r.text) for r in drop_shared_lines(rows).collect())
    assert got == [(0, "rest"), (1, ""), (1, ""), (2, line)]


def test_empty_table_and_clashing_names(texts):
    assert drop_shared_lines(texts()).count() == 0
    df = texts((1, "a\nb")).withColumns({"N_Lines": F.lit("old"), "key": F.lit(1), "drop": F.lit(2), "id": F.lit(3)})
    row = drop_shared_lines(df).collect()[0]
    assert (row.n_lines, row.key, row["drop"], row.id, row.text) == (2, 1, 2, 3, "a\nb")
