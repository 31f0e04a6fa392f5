"""SQL twins of this package's queries, for DuckDB."""

from __future__ import annotations

# The 32 letters of a base-32 digest, five hexadecimal digits (four letters) at a time.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"((('0x' || substr(sha, {5 * block + 1}, 5))::BIGINT >> {shift}) & 31)::INT + 1, 1)"
    for block in range(8)
    for shift in (15, 10, 5, 0)
)
OP5 = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
     d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS sha FROM p),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first FROM d)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

# The table of the reflected CRC-32, from its polynomial.
CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"""


def crc32(text: str) -> str:
    """CRC-32 of the UTF-8 of a SQL text; the table ``crc`` must be at hand."""
    code = f"hex(encode({text}))"
    codes = f"list_transform(range(0, length({code})::BIGINT, 2), lambda i: ('0x' || substr({code}, i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295)"


# Near words: equal after one letter of each is blanked at the same place, or one less a letter is the other.
OP12 = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents WHERE text IS NOT NULL),
per_doc AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY ALL),
summed AS (SELECT run, k, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM per_doc, crc),
slipped AS (
  SELECT CASE WHEN h % 31 = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM summed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
spots AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM spots),
blanked AS (SELECT word, n, i, substr(word, 1, i - 1) || chr(1) || substr(word, i + 1) AS rest FROM spots),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM blanked a JOIN blanked b ON a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT less.word, words.word, words.n FROM less JOIN words ON less.rest = words.word
  UNION ALL SELECT words.word, less.word, less.n FROM less JOIN words ON less.rest = words.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS top, arg_min(other, (-other_n, other)) AS other FROM near GROUP BY word),
formed AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN top >= 10 * n THEN other END AS form, CASE WHEN top >= 10 * n THEN top END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word),
ways AS (
  SELECT word, word AS tip, form AS ahead FROM formed
  UNION ALL SELECT ways.word, ways.ahead, formed.form FROM ways JOIN formed ON ways.ahead = formed.word)
SELECT formed.word, formed.form, ways.tip AS root, n, n_near, form_n
FROM formed JOIN ways ON formed.word = ways.word AND ways.ahead IS NULL
"""


def _led(cost: int, letter: str, path: str) -> str:
    """A path (nine digits of cost, then letters) behind one more edit."""
    return f"(lpad((left({path}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{letter}' || substr({path}, 10))"


_FREE = {"e": "u", "s": "u", "u": "a", "a": "u"}
_AFTER = {"e": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def _step(state: str) -> str:
    """The best path from a state when the next row is deleted, kept or given another role."""
    extra = "CASE WHEN fault = 3 THEN 5 ELSE 0 END"
    kept = " ".join(f"WHEN initial = '{i}' THEN {_led(f'({extra})', 'K', to)}" for i, to in _AFTER[state].items())
    usable = f"CASE WHEN fault IN (1, 2) THEN NULL ELSE least(CASE {kept} END, {_led(f'(1 + {extra})', 'R', _FREE[state])}) END"
    return f"least({_led(2, 'D', state)}, {usable})"


OP13 = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
marked AS (SELECT *, {crc32("name")} % 20 AS mark FROM plain, crc),
kept AS (
  SELECT conv_id, turn, CASE WHEN mark = 4 THEN 'user' ELSE role END AS role,
         CASE mark WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN mark = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM marked WHERE mark <> 0),
placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS final
  FROM kept),
judged AS (
  SELECT *, CASE WHEN final = '' THEN 1 WHEN nth > 1 THEN 2 WHEN final NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM placed),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
paths AS (
  SELECT conv_id, n AS i, '000000000' AS e, '000000010II' AS s, '000000005I' AS u, '000000000' AS a FROM counted
  UNION ALL
  SELECT conv_id, i, least(e, {_led(5, "I", "u")}), least(s, {_led(5, "I", "u")}), u, a FROM (
    SELECT conv_id, i, e, s, least(u, {_led(5, "I", "a")}) AS u, least(a, {_led(5, "I", "u")}) AS a FROM (
      SELECT p.conv_id, p.i - 1 AS i, {_step("e")} AS e, {_step("s")} AS s, {_step("u")} AS u, {_step("a")} AS a
      FROM paths p JOIN judged j ON p.conv_id IS NOT DISTINCT FROM j.conv_id AND p.i = j.place) x) y),
best AS (SELECT conv_id, left(e, 9)::BIGINT AS cost, substr(e, 10) AS audit FROM paths WHERE i = 0),
told AS (
  SELECT conv_id, audit, 1::BIGINT AS pos, 0::BIGINT AS used, 'e' AS state, '' AS said FROM best
  UNION ALL
  SELECT conv_id, audit, pos + 1, used, state,
         said || CASE WHEN letter = 'D' THEN '' ELSE CASE WHEN said = '' THEN '' ELSE chr(10) END ||
           CASE WHEN letter = 'K' THEN role WHEN state = 'u' THEN 'user' ELSE 'assistant' END || ':' ||
           CASE WHEN letter = 'I' THEN '' ELSE text END END FROM (
    SELECT t.conv_id, audit, pos, said, letter, role, text, CASE WHEN letter = 'I' THEN used ELSE used + 1 END AS used,
           CASE letter WHEN 'D' THEN state WHEN 'K' THEN initial ELSE CASE WHEN state = 'u' THEN 'a' ELSE 'u' END END AS state
    FROM (SELECT *, audit[pos] AS letter FROM told WHERE pos <= length(audit)) t
    LEFT JOIN judged j ON t.conv_id IS NOT DISTINCT FROM j.conv_id AND t.used + 1 = j.place) x),
final AS (SELECT conv_id, sha256(said) AS repaired_sha256 FROM told WHERE pos > length(audit)),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM every LEFT JOIN counted ON every.conv_id IS NOT DISTINCT FROM counted.conv_id
LEFT JOIN best ON every.conv_id IS NOT DISTINCT FROM best.conv_id
LEFT JOIN final ON every.conv_id IS NOT DISTINCT FROM final.conv_id
"""


def _held(pattern: str) -> str:
    """How many characters of a text match a class."""
    return f"(length(text) - length(regexp_replace(text, '{pattern}', '', 'g')))::BIGINT"


_CLASSES = {
    "lower": "[a-z]",
    "upper": "[A-Z]",
    "digit": "[0-9]",
    "space": "[ \\t\\x0B\\x0C\\r]",
    "newline": "\\n",
    "sentence": "[.,;:!?''\"()-]",
    "beyond": "[^\\x00-\\x7F]",
}
_KNOWN = ", ".join(f"{_held(pattern)} AS c_{name}" for name, pattern in _CLASSES.items())
_NAMES = [f"c_{name}" for name in _CLASSES]
_GAIN = """sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2"""

OP11 = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text FROM documents),
listed AS (SELECT row, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM docs),
words AS (SELECT row, unnest(words) AS word FROM listed),
windows AS (
  SELECT row, unnest(range(1, len(words) - 6)) AS i, unnest(list_transform(range(1, len(words) - 6), lambda i: words[i:i + 7])) AS run
  FROM listed WHERE len(words) >= 8),
again AS (SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY row, run) AS times FROM windows) w WHERE times > 1),
covered AS (SELECT row, count(DISTINCT i) AS n FROM (SELECT row, unnest(range(i, i + 8)) AS i FROM again) s GROUP BY row),
lines AS (SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs),
repeats AS (
  SELECT row, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY row),
based AS (
  SELECT docs.row, doc_id, lang, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         {_held("[#*$%&|<>]")} AS n_symbols, coalesce(repeats.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         length(text) AS chars, {_KNOWN}
  FROM docs JOIN listed USING (row) LEFT JOIN repeats USING (row) LEFT JOIN covered USING (row)),
failed AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, chars - {" - ".join(_NAMES)} AS c_other FROM based),
plain AS (
  SELECT row, trim(translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.,;:!?') AS word,
         count(*) AS n FROM words GROUP BY ALL),
spoken AS (
  SELECT lang, word, sum(n) AS n FROM plain JOIN failed USING (row) WHERE NOT base_failed AND lang IS NOT NULL GROUP BY ALL),
sizes AS (SELECT lang, sum(n) AS total FROM spoken GROUP BY lang),
known AS (SELECT lang, total FROM sizes WHERE total >= (SELECT sum(total) FROM sizes) * (1 / 1000)),
common AS (
  SELECT lang, word, n FROM spoken JOIN known USING (lang) WHERE word <> ''
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 64),
word_refs AS (
  SELECT lang, word, n / total AS q FROM common JOIN known USING (lang)
  UNION ALL SELECT lang, NULL, (any_value(total) - sum(n)) / any_value(total) FROM common JOIN known USING (lang) GROUP BY lang),
class_counts AS (UNPIVOT (SELECT row, lang, base_failed, {", ".join(_NAMES)}, c_other FROM failed) ON {", ".join(_NAMES)}, c_other INTO NAME class VALUE n),
class_sums AS (SELECT lang, class, sum(n) AS n FROM class_counts JOIN known USING (lang) WHERE NOT base_failed GROUP BY ALL),
class_refs AS (SELECT lang, class, n / sum(n) OVER (PARTITION BY lang) AS q FROM class_sums),
tried AS (
  SELECT f.row, n_words, chars, k.lang FROM failed f, known k
  WHERE NOT base_failed AND (f.lang IS NULL OR f.lang IN (SELECT lang FROM known))),
class_far AS (
  SELECT row, lang, sqrt(greatest({_GAIN}, 0)) AS far FROM (
    SELECT t.row, t.lang, c.n / t.chars AS p, coalesce(r.q, 0) AS q
    FROM tried t JOIN class_counts c ON t.row = c.row LEFT JOIN class_refs r ON r.lang = t.lang AND r.class = c.class) x
  GROUP BY row, lang),
in_common AS (
  SELECT t.row, t.lang, c.word, coalesce(p.n, 0) AS n, t.n_words FROM tried t JOIN common c ON t.lang = c.lang
  LEFT JOIN plain p ON p.row = t.row AND p.word = c.word),
word_bins AS (
  SELECT row, lang, word, n / n_words AS p FROM in_common
  UNION ALL SELECT row, lang, NULL, (any_value(n_words) - sum(n)) / any_value(n_words) FROM in_common GROUP BY row, lang),
word_far AS (
  SELECT row, lang, sqrt(greatest({_GAIN}, 0)) AS far FROM (
    SELECT b.row, b.lang, p, q FROM word_bins b JOIN word_refs r ON b.lang = r.lang AND b.word IS NOT DISTINCT FROM r.word) x
  GROUP BY row, lang),
close AS (
  SELECT row, bool_or((chars < 300 OR c.far <= 0.26) AND (n_words < 50 OR w.far <= 0.45)) AS near
  FROM tried JOIN class_far c USING (row, lang) JOIN word_far w USING (row, lang) GROUP BY row)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(near, TRUE) AS kept
FROM failed LEFT JOIN close USING (row)
"""
