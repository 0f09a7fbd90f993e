"""SQL of the operators on digests and words, for comparison."""

from __future__ import annotations


def crc32(value: str) -> str:
    """CRC-32 (reflected, polynomial EDB88320) of a text, byte by byte; needs the table ``crc_table`` of ``CRC_TABLE``."""
    octets = f"list_transform(range(1, 2 * strlen({value}), 2), lambda i: ('0x' || substr(hex(encode({value})), i, 2))::UBIGINT)"
    step = "xor(c >> 8, t[(xor(c, b) & 255)::INT + 1])"
    return f"xor(list_reduce({octets}, lambda c, b: {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


_HALVED = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END"
CRC_TABLE = f"""crc_table AS (
        SELECT list(list_reduce(range(8)::UBIGINT[], lambda v, k: {_HALVED}, x::UBIGINT) ORDER BY x) AS t FROM range(256) r(x))"""

EXACT_DEDUP = """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
        sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(nodes: str, count: int) -> str:
    """Lists of the nodes of all levels from ``n0`` on; the only node of a level stays as it is."""
    out, part = [], "sha256(array_to_string({0}[16 * i + 1 : 16 * i + 16], ''))"
    for level in range(count):
        hashed = f"list_transform(range(0, (len({nodes}{level}) + 15) // 16), lambda i: {part.format(f'{nodes}{level}')})"
        out.append(f"CASE WHEN len({nodes}{level}) > 1 THEN {hashed} ELSE {nodes}{level} END AS {nodes}{level + 1}")
    return ", ".join(out)


def _side(nodes: str, level: int, place: str, side: str) -> str:
    """Siblings on one side of the node above a place, one after another."""
    at = f"({place} // {16**level})"
    run = f"({at} // 16 * 16)"
    cut = f"[{run} + 1 : {at}]" if side == "left" else f"[{at} + 2 : {run} + 16]"
    return f"array_to_string({nodes}{level}{cut}, '')"


def _folded(leaf: str, levels: list[tuple[str, int, str]]) -> str:
    out = [f"{leaf} AS f0"]
    for k, (nodes, level, place) in enumerate(levels):
        left, right = (_side(nodes, level, place, side) for side in ("left", "right"))
        out.append(f"CASE WHEN len({nodes}{level}) > 1 THEN sha256({left} || f{k} || {right}) ELSE f{k} END AS f{k + 1}")
    return ", ".join(out)


#: Levels of both trees in the SQL: up to 16 ** 5 leaves in a source and as many sources.
_DEPTH = 5
_PATH = [("n", k, "p") for k in range(_DEPTH)] + [("m", k, "q") for k in range(_DEPTH)]
MERKLE = f"""
    WITH {CRC_TABLE},
    d AS (
        SELECT doc_id, source, {_leaf('text')} AS leaf,
            {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lower_leaf,
            coalesce({crc32('(doc_id::VARCHAR)')} % 5 = 0, false) AS touched
        FROM documents, crc_table),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM d),
    s AS (
        SELECT *, n{_DEPTH}[1] AS subroot
        FROM (SELECT source, list(leaf ORDER BY p) AS n0, {_levels('n', _DEPTH)} FROM placed GROUP BY source)),
    named AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS q FROM s),
    r AS (SELECT *, m{_DEPTH}[1] AS root FROM (SELECT list(subroot ORDER BY q) AS m0, {_levels('m', _DEPTH)} FROM named)),
    f AS (
        SELECT doc_id, leaf, subroot, root, sha256({' || '.join(_side(n, k, p, a) for n, k, p in _PATH for a in ('left', 'right'))})
            AS proof_sha256, {_folded('CASE WHEN touched THEN lower_leaf ELSE leaf END', _PATH)}
        FROM placed JOIN named ON placed.source IS NOT DISTINCT FROM named.source CROSS JOIN r)
    SELECT doc_id, leaf, subroot, root, proof_sha256, f{len(_PATH)} AS folded_root, f{len(_PATH)} = root AS verified FROM f"""

_H = crc32("(coalesce(doc_id::VARCHAR, '') || ':' || run)")
#: DuckDB's edit distance counts bytes, so that letters beyond ASCII are mapped to its other characters.
_BEYOND, _ASCII = "".join(map(chr, range(0xC0, 0x100))), "".join(map(chr, range(32, 96))).replace("'", "''")
#: Edit distances only of words with a common half.
SPELLING = rf"""
    WITH RECURSIVE {CRC_TABLE},
    runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
        GROUP BY ALL),
    hashed AS (SELECT run, n, {_H}::BIGINT AS h FROM runs, crc_table),
    v AS MATERIALIZED (
        SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
            sum(n)::BIGINT AS n
        FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
    halves AS (
        SELECT word, translate(word, '{_BEYOND}', '{_ASCII}') AS plain, n, size, side, CASE WHEN side = 0 THEN left(word, size // 2) ELSE right(word, size - size // 2) END AS half
        FROM (SELECT *, unnest([0, 1]) AS side FROM (SELECT *, unnest([length(word), length(word) + 1]) AS size FROM v))),
    near AS MATERIALIZED (
        SELECT DISTINCT a.word, a.n, b.word AS form, b.n AS form_n
        FROM halves a JOIN halves b USING (size, side, half)
        WHERE a.word <> b.word AND levenshtein(a.plain, b.plain) = 1),
    best AS (
        SELECT word, count(*)::BIGINT AS n_near, arg_min(form, (-form_n, form)) AS form, max(form_n) AS form_n FROM near GROUP BY word),
    f AS MATERIALIZED (
        SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form,
            CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
        FROM v LEFT JOIN best USING (word)),
    up(word, root, next) AS (
        SELECT word, word, form FROM f
        UNION ALL SELECT up.word, up.next, f.form FROM up JOIN f ON f.word = up.next)
    SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n FROM f JOIN up ON up.word = f.word AND up.next IS NULL"""
