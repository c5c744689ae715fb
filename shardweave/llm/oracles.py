"""SQL twins of the operators whose SQL is long.  They share no code with the operators."""

import re

FILL_IN_MIDDLE = r"""WITH RECURSIVE units AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
      regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u
    FROM documents),
  hashed AS (
    SELECT *, len(u) AS n, list_transform([0, 1, 2, 3], lambda k:
      list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(range(1, 9), lambda j:
        CAST(instr('0123456789abcdef', substr(digest, 8 * k + CAST(j AS INTEGER), 1)) - 1 AS BIGINT))),
        lambda a, b: 16 * a + b)) AS h
    FROM units),
  cuts AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
      CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100
        THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM hashed),
  parts AS (
    SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
      array_to_string(u[b + 1:n], '') AS s
    FROM cuts),
  made AS (
    SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
      ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output
    FROM parts)
  SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars, sha256(output) AS output_sha256,
    sha256(text) AS restored_sha256
  FROM made"""

CONVERSATION_REPAIR = r"""WITH RECURSIVE shifts AS (
    SELECT range AS i, range AS v, 0 AS k FROM range(256)
    UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM shifts WHERE k < 8),
  crc AS (SELECT list(v ORDER BY i) AS t FROM shifts WHERE k = 8),
  told AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id
    FROM conversations),
  kinds AS (
    SELECT told.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(id) + 1),
        lambda j: CAST(ascii(substr(id, CAST(j AS INTEGER), 1)) AS BIGINT))),
        lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
    FROM told, crc),
  damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
      CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM kinds),
  numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM damaged),
  rated AS (
    SELECT *, substr(role, 1, 1) AS ini,
      CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
      lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
    FROM numbered),
  counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
      count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
      count(*) FILTER (fault = 'truncated') AS truncated,
      count(*) FILTER (pos > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rated GROUP BY conv_id),
  -- where the output may stand: 0 nothing yet, 1 system, 2 user, 3 assistant
  inserts(st, mid, letters, cost, lines) AS (VALUES
    (0, 0, '', 0, ''), (0, 2, 'I', 2, 'user:' || chr(10)), (0, 3, 'II', 4, 'user:' || chr(10) || 'assistant:' || chr(10)),
    (1, 1, '', 0, ''), (1, 2, 'I', 2, 'user:' || chr(10)), (1, 3, 'II', 4, 'user:' || chr(10) || 'assistant:' || chr(10)),
    (2, 2, '', 0, ''), (2, 3, 'I', 2, 'assistant:' || chr(10)), (2, 2, 'II', 4, 'assistant:' || chr(10) || 'user:' || chr(10)),
    (3, 3, '', 0, ''), (3, 2, 'I', 2, 'user:' || chr(10)), (3, 3, 'II', 4, 'user:' || chr(10) || 'assistant:' || chr(10))),
  edits(mid, letter, ini, nxt, cost, role) AS (VALUES
    (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL), (3, 'K', 'u', 2, 0, NULL),
    (0, 'R', NULL, 2, 2, 'user'), (1, 'R', NULL, 2, 2, 'user'), (2, 'R', NULL, 3, 2, 'assistant'), (3, 'R', NULL, 2, 2, 'user'),
    (0, 'D', NULL, 0, 3, NULL), (1, 'D', NULL, 1, 3, NULL), (2, 'D', NULL, 2, 3, NULL), (3, 'D', NULL, 3, 3, NULL)),
  ways AS (
    SELECT i.st, e.letter, e.ini, e.nxt, i.cost + e.cost AS cost, i.letters || e.letter AS letters, i.lines, e.role
    FROM inserts i JOIN edits e ON e.mid = i.mid),
  walk AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS st, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''} AS best FROM counts
    UNION ALL
    SELECT w.conv_id, w.pos + 1, y.nxt, min({
        'cost': w.best.cost + y.cost + CASE WHEN r.fault = 'truncated' AND y.letter <> 'D' THEN 1 ELSE 0 END,
        'audit': w.best.audit || y.letters,
        'lines': w.best.lines || y.lines || CASE WHEN y.letter = 'D' THEN '' ELSE coalesce(y.role, r.role) || ':' || r.text || chr(10) END})
    FROM walk w JOIN rated r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1
    JOIN ways y ON y.st = w.st AND (y.ini IS NULL OR y.ini = r.ini) AND (y.letter = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
    GROUP BY w.conv_id, w.pos, y.nxt),
  ends AS (
    SELECT w.conv_id, min({'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.letters, 'lines': w.best.lines || i.lines}) AS best
    FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.pos
    JOIN inserts i ON i.st = w.st AND i.mid IN (0, 3) GROUP BY w.conv_id)
  SELECT d.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
    coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost,
    coalesce(e.best.audit, '') AS audit,
    sha256(CASE WHEN coalesce(e.best.lines, '') = '' THEN '' ELSE substr(e.best.lines, 1, length(e.best.lines) - 1) END) AS repaired_sha256
  FROM (SELECT DISTINCT conv_id FROM conversations) d
  LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
  LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM d.conv_id"""


def _expression(markup: str) -> str:
    """A regular expression over words that each stand between two spaces of their own."""

    def words(text):
        return "".join(f" {w} " for w in re.findall("[a-z0-9]+", text.lower()))

    out = []
    for k, part in enumerate(re.split("<<(.*?)>>", markup)):
        if k % 2 == 0:
            out.append(words(part))
        elif part == "beginOptional":
            out.append("(?:")
        elif part == "endOptional":
            out.append(")?")
        else:
            told = dict(p.split("=", 1) for p in part.split(";")[1:])
            word = "[^ ]+" if told["match"] == ".+" else told["match"]
            out.append(f"(?: (?:{word}) ){{{told['min']},{told['max']}}}")
    return "".join(out)


def license_sql(phrases, templates) -> str:
    """Places from the pieces between matches of each expression; the words they
    cover are counted one by one."""
    asked = [(p.label, True, _expression(p.words)) for p in phrases] + [(t.label, False, _expression(t.markup)) for t in templates]
    matched = "\n    UNION ALL ".join(
        f"SELECT doc_id, row_id, '{label}' AS label, {base} AS base, regexp_extract_all(w, '{rx}') AS hits,"
        f" string_split_regex(w, '{rx}') AS rest FROM words WHERE regexp_matches(w, '{rx}')"
        for label, base, rx in asked
    )
    return (
        r"""WITH told AS (
    SELECT doc_id, row_number() OVER () AS row_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS l FROM documents),
  words AS (SELECT doc_id, row_id, len(l) AS n, array_to_string(list_transform(l, lambda x: ' ' || x || ' '), '') AS w FROM told),
  matched AS ("""
        + matched
        + r"""),
  sizes AS (
    SELECT doc_id, row_id, label, base, list_transform(hits, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) AS h,
      list_transform(rest, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) AS r FROM matched),
  places AS (
    SELECT row_id, label, base, h[k] AS many, list_sum(r[1:k]) + coalesce(list_sum(h[1:k - 1]), 0) AS start
    FROM (SELECT *, unnest(range(1, len(h) + 1)) AS k FROM sizes)),
  found AS (
    SELECT row_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
      string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY row_id),
  covered AS (
    SELECT row_id, count(DISTINCT word) AS c
    FROM (SELECT row_id, unnest(range(CAST(start AS BIGINT), CAST(start + many AS BIGINT))) AS word FROM places) GROUP BY row_id)
  SELECT w.doc_id, w.n AS n_words, coalesce(f.n_base, 0) AS n_base, CAST(f.first_word AS BIGINT) AS first_word,
    CAST(f.last_word AS BIGINT) AS last_word, coalesce(f.base_labels, '') AS base_labels, coalesce(f.labels, '') AS labels,
    CASE WHEN w.n > 0 THEN coalesce(v.c, 0) / w.n ELSE CAST(0 AS DOUBLE) END AS score
  FROM words w LEFT JOIN found f USING (row_id) LEFT JOIN covered v USING (row_id)"""
    )
