"""SQL for the queries whose results SQL can express."""

from __future__ import annotations

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: The table of CRC-32 by its rule: eight steps of a shift and, where the last bit was set, the fixed polynomial.
_CRC_TABLE = """crc_table AS (SELECT list(x ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(0, 8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS x
    FROM (SELECT unnest(range(0, 256)) AS i)))"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text; ``t`` of ``crc_table`` must be in reach."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


PREFIX_TRIE = f"""WITH {_CRC_TABLE},
  own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS own
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
  heads AS (SELECT conv_id, own, CAST({crc32("CAST(conv_id AS VARCHAR)")} % 6 AS BIGINT) AS h FROM own, crc_table),
  rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:h], c.own[h + 1:]) AS s
    FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
  members AS (SELECT conv_id, d, len(s) AS n, CASE WHEN d > 0 THEN length(s[d].x) ELSE 0 END AS chars,
      sha256(to_json(s[1:d])) AS k, CASE WHEN d > 0 THEN sha256(to_json(s[1:d - 1])) END AS up
    FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
  nodes AS (SELECT d, k, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
      string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d) AS ends FROM members GROUP BY d, k),
  below AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
  full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN below USING (d, k)),
  sums AS (SELECT v.d, v.k, sum((u.n_convs - 1) * u.chars)::BIGINT AS saved, count(*) FILTER (WHERE u.n_children = 0) AS leaves
    FROM full_nodes u JOIN members v ON v.conv_id = u.conv_id AND v.d <= u.d GROUP BY ALL)
  SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.leaves AS n_leaves,
    s.saved AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
  FROM full_nodes f JOIN sums s USING (d, k) LEFT JOIN nodes p ON p.d = f.d - 1 AND p.k = f.up"""


PASSAGE_REPEATS = r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
  windows AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS x
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
  firsts AS (SELECT x, min(doc_id) AS first FROM windows GROUP BY x),
  gone AS (SELECT DISTINCT doc_id, i + k AS i FROM windows JOIN firsts USING (x), (SELECT unnest(range(0, 50)) AS k)
    WHERE doc_id > first),
  each AS (SELECT doc_id, ws[i] AS v, i FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
  kept AS (SELECT doc_id, string_agg(v, ' ' ORDER BY i) AS kept FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
  counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
  FROM w LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def _then(left: str, cost: str, letter: str) -> str:
    """A cost of nine digits with its letters, after one more edit in front."""
    return f"(lpad(CAST(CAST(left({left}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({left}, 10))"


_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
_NEVER = "'900000000'"


def _edited(state: int) -> str:
    """Least cost and letters from a state when the row comes next."""
    cut, after = "5 * truncated", f"w{_NEXT[state]}"
    keeps = {"a": "w3"} if state == 2 else {"u": "w2"} | ({"s": "w1"} if state == 0 else {})
    kept = " ".join(f"WHEN initial = '{i}' THEN {_then(w, cut, 'K')}" for i, w in keeps.items())
    return (
        f"least({_then(f'w{state}', '2', 'D')}, CASE WHEN must_go THEN {_NEVER} ELSE {_then(after, '1 + ' + cut, 'R')} END,"
        f" CASE WHEN must_go THEN {_NEVER} {kept} ELSE {_NEVER} END)"
    )


def _inserted(state: int) -> str:
    once = f"e{_NEXT[state]}"
    twice = f", {_then('e3', '10', 'II')}" if state < 2 else ""
    return f"least(e{state}, {_then(once, '5', 'I')}{twice})"


STRUCTURE_REPAIR = f"""WITH RECURSIVE {_CRC_TABLE},
  named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
  kinds AS (SELECT *, {crc32("name")} % 20 AS kind FROM named, crc_table),
  damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
      CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM kinds),
  seen AS (SELECT *, trim(text, {_BLANKS}) AS words, role[1] AS initial,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged),
  faults AS (SELECT *, CASE WHEN words = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
      WHEN right(words, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
      lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM seen),
  lines AS (SELECT *, fault IN ('blank', 'duplicate') AS must_go, CAST(fault = 'truncated' AS INTEGER) AS truncated FROM faults),
  convs AS (SELECT DISTINCT conv_id FROM conversations),
  stats AS (SELECT c.conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
      count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
      count(*) FILTER (WHERE fault = 'truncated') AS truncated,
      count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM convs c LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
  steps(conv_id, i, w0, w1, w2, w3) AS (
    SELECT conv_id, n + 1, '000000000', '000000010II', '000000005I', '000000000' FROM stats
    UNION ALL
    SELECT conv_id, i, {", ".join(_inserted(s) for s in range(4))}
    FROM (SELECT l.conv_id, l.i, {", ".join(f"{_edited(s)} AS e{s}" for s in range(4))}
      FROM steps p JOIN lines l ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.i = p.i - 1)),
  solved AS (SELECT conv_id, CAST(left(w0, 9) AS BIGINT) AS cost, substr(w0, 10) AS audit FROM steps WHERE i = 1),
  letters AS (SELECT conv_id, p, audit[p] AS letter, len(replace(audit, 'D', '')) % 2 AS odd,
      len(replace(audit[1:p], 'D', '')) AS nth_out, len(replace(audit[1:p], 'I', '')) AS nth_in
    FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS p FROM solved)),
  shown AS (SELECT t.conv_id, p, CASE WHEN letter = 'K' THEN l.role WHEN (nth_out - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN letter = 'I' THEN '' ELSE l.text END AS line
    FROM letters t LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM t.conv_id AND l.i = nth_in WHERE letter <> 'D'),
  joined AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS repaired FROM shown GROUP BY conv_id)
  SELECT s.conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256(coalesce(repaired, '')) AS repaired_sha256
  FROM stats s JOIN solved v ON v.conv_id IS NOT DISTINCT FROM s.conv_id
  LEFT JOIN joined j ON j.conv_id IS NOT DISTINCT FROM s.conv_id"""
