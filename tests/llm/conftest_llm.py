"""Helpers of the tests in this folder."""

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LINE = "the quick brown fox jumps over the lazy dog and then runs far away from the big bad wolf of the north"
LONG = " ".join(f"word{i % 9973} of thé" for i in range(60_000))

#: Nulls in every column, empty and blank texts, a very long one, repeated rows, shared ids, ties.
ODD_ROWS = [
    (None, None, None, None, None),
    (None, LINE, "en", None, 3),
    (1, None, "en", "a", None),
    (2, "", None, "a", 0),
    (3, " \n\t ", "en", None, 4),
    (4, LINE, "en", "a", 1),
    (4, LINE, "en", "a", 1),
    (5, LINE, None, "a", 1),
    (6, "x", "de", "b", 1),
    (6, "another text under the same id", "de", "b", 1),
    (7, LONG, "fr", "b", len(LONG)),
    (8, "12 34 ... !!", "en", "b", 12),
    (9, "\x00 \x1c  　日本語\r\nx" + "y" * 3000, "en", "c", 5),
    (10, LINE + " " + LINE.upper(), "en", "c", 5),
]

#: Columns of other meaning whose names clash with those of results.
CLASHING = ("score", "spans", "node", "copy", "kept", "rank", "length", "sequence_id", "size", "class_id", "rest", "first", "row")


def pairs(rows, key):
    out = {}
    for r in rows:
        out.setdefault(r[key], []).append(r)
    return out
