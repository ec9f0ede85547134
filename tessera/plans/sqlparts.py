"""DuckDB SQL fragments mirroring the Spark builders (for the oracle twins)."""

from __future__ import annotations

from ..registry import END_TURN, START_MODEL, START_USER, Task

SPLIT = "CASE WHEN {c} % 10 < 8 THEN 'train' WHEN {c} % 10 = 8 THEN 'validation' ELSE 'test' END"
WORD_RE = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def nz(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), '')"


def prompt(inp: str, lab: str, system: str, prefix: str) -> str:
    head = START_USER + (system + "\n\n" if system else "") + prefix + ": "
    return (f"{lit(head)} || {strip(nz(inp))} || {lit(chr(10) + END_TURN + chr(10) + START_MODEL)} || "
            f"{strip(nz(lab))} || {lit(chr(10) + END_TURN)}")


def task_prompt(task: Task, inp: str, lab: str) -> str:
    return prompt(inp, lab, task.system_prompt, task.prefix)


def inference(inp: str, system: str, prefix: str) -> str:
    head = START_USER + (system + "\n\n" if system else "") + prefix + ": "
    return f"{lit(head)} || {nz(inp)} || {lit(chr(10) + END_TURN + chr(10) + START_MODEL)}"


def decode_passthrough(raw: str, mapping: dict) -> str:
    r = nz(raw)
    cases = " ".join(f"WHEN {lit(str(k))} THEN {lit(v)}" for k, v in mapping.items())
    lookup = f"(CASE CAST(TRY_CAST({r} AS INTEGER) AS VARCHAR) {cases} END)"
    return f"(CASE WHEN regexp_full_match({r}, '[0-9]+') THEN coalesce({lookup}, {r}) ELSE {r} END)"


def decode_default(code: str, mapping: dict, default: str) -> str:
    cases = " ".join(f"WHEN {k} THEN {lit(v)}" for k, v in mapping.items())
    return f"coalesce((CASE {code} {cases} END), {lit(default)})"


def tokens(x: str, lower: bool = False) -> str:
    src = f"lower({nz(x)})" if lower else nz(x)
    return f"regexp_extract_all({src}, {lit(WORD_RE)})"


LABELLED = ("labelled AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
            "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)")

PREDS = (LABELLED + ", preds AS (SELECT doc_id AS example_id, CAST(quality AS VARCHAR) AS y_true, "
         "CAST(doc_id % 2 AS VARCHAR) AS y_base, CASE WHEN n_chars >= 1400 THEN '1' ELSE '0' END AS y_ft, "
         "lang, text FROM labelled), "
         "long AS (SELECT example_id, y_true, 'base' AS system, y_base AS y_pred, lang FROM preds "
         "UNION ALL SELECT example_id, y_true, 'ft' AS system, y_ft AS y_pred, lang FROM preds)")

PAIRS = ("pairs AS (SELECT c.conv_id, c.turn, "
         "CASE WHEN c.conv_id % 10 = 0 THEN upper(replace(p.text, 'ß', 'ss')) ELSE c.text END AS candidate, "
         "p.text AS reference, n.text AS reference2 "
         "FROM conversations c "
         "JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1 AND p.role = 'user' "
         "LEFT JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1 AND n.role = 'user' "
         "WHERE c.role = 'assistant')")

SRH = ("srh AS (SELECT a.conv_id, a.turn, a.text AS source, b.text AS reference, c.text AS hypothesis "
       "FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 "
       "JOIN conversations c ON c.conv_id = a.conv_id AND c.turn = a.turn + 2)")

BOUNDARIES = ("bnd AS (SELECT user_id AS stream, ts, event_id, CAST(event_type = 'signup' AS INTEGER) AS gold_b, "
              "CAST(coalesce((event_type = 'signup' AND value > 50) OR (event_type = 'error' AND value > 100), false) "
              "AS INTEGER) AS pred_b FROM events), "
              "bpos AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY ts, event_id) - 1 AS pos, "
              "sum(gold_b) OVER (PARTITION BY stream ORDER BY ts, event_id) AS cum_gold_b, "
              "sum(pred_b) OVER (PARTITION BY stream ORDER BY ts, event_id) AS cum_pred_b FROM bnd)")


def bio_cte() -> str:
    """Token rows with gold/pred tags, same rule as fixtures.bio."""
    def tag(restrict: bool) -> str:
        def ent(t: str) -> str:
            c = f"regexp_matches({t}, '^\\p{{Lu}}')"
            return f"coalesce({c} AND length({t}) > 3, false)" if restrict else f"coalesce({c}, false)"
        etype = "(['PER','ORG','LOC'])[length(token) % 3 + 1]"
        return (f"CASE WHEN NOT {ent('token')} THEN 'O' WHEN {ent('prev_token')} THEN 'I-' || {etype} "
                f"ELSE 'B-' || {etype} END")
    return ("toks AS (SELECT doc_id, " + tokens("text") + " AS toks FROM documents), "
            "tok AS (SELECT doc_id, toks, unnest(toks) AS token, unnest(generate_series(0, len(toks) - 1)) AS pos "
            "FROM toks), "
            "tok2 AS (SELECT doc_id, pos, token, CASE WHEN pos > 0 THEN toks[pos] END AS prev_token FROM tok), "
            f"bio AS (SELECT doc_id, CAST(pos AS BIGINT) AS pos, token, {tag(False)} AS gold_tag, "
            f"{tag(True)} AS pred_tag FROM tok2)")


# ---------------------------------------------------------------- n-grams

def word_grams(t: str, n: int) -> str:
    return f"list_transform(generate_series(1, len({t}) - {n} + 1), lambda i: array_to_string({t}[i:i + {n} - 1], ' '))"


def char_grams(s: str, n: int) -> str:
    t = f"regexp_replace(coalesce({s}, ''), '\\s', '', 'g')"
    return f"list_transform(generate_series(1, length({t}) - {n} + 1), lambda i: substring({t}, i, {n}))"


def gram_counts(base: str, keys: list[str], sides: dict[str, dict[int, str]]) -> str:
    """SELECT producing (keys, n, g, <side counts>) from relation ``base``."""
    k = ", ".join(keys)
    names = list(sides)
    branches = []
    for si, name in enumerate(names):
        for n, expr in sides[name].items():
            branches.append(f"SELECT {k}, {n} AS n, unnest({expr}) AS g, {si} AS s FROM {base}")
    sums = ", ".join(f"CAST(sum(CASE WHEN s = {si} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"
                     for si, name in enumerate(names))
    return f"SELECT {k}, n, g, {sums} FROM ({' UNION ALL '.join(branches)}) x GROUP BY {k}, n, g"


def normalise(x: str) -> str:
    s = f"regexp_replace(lower({nz(x)}), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')"
    s = f"regexp_replace({s}, '\\s+', ' ', 'g')"
    return strip(s)


def norm_tokens(x: str) -> str:
    n = normalise(x)
    return f"(CASE WHEN {n} = '' THEN []::VARCHAR[] ELSE string_split({n}, ' ') END)"


def overlap_stats(src: str, keys: list[str], cand: str, ref: str, orders: list[int]) -> str:
    """CTE text: tk, cnt, st0, st (keys, n, overlap, c_total, r_total) over relation src."""
    k = ", ".join(keys)
    ords = ", ".join(str(n) for n in orders)
    return (f"tk AS (SELECT {k}, {tokens(cand, True)} AS c, {tokens(ref, True)} AS r FROM {src}), "
            f"cnt AS ({gram_counts('tk', keys, {'c': {n: word_grams('c', n) for n in orders}, 'r': {n: word_grams('r', n) for n in orders}})}), "
            f"st0 AS (SELECT {k}, n, sum(least(c, r)) AS overlap, sum(c) AS c_total, sum(r) AS r_total FROM cnt GROUP BY {k}, n), "
            f"grid AS (SELECT {k}, unnest([{ords}]) AS n FROM {src}), "
            f"st AS (SELECT grid.*, coalesce(overlap, 0) AS overlap, coalesce(c_total, 0) AS c_total, "
            f"coalesce(r_total, 0) AS r_total FROM grid LEFT JOIN st0 USING ({k}, n))")


def bleu_select(per_order: str, max_n: int, num: str = "overlap", den: str = "c_total", out: str = "bleu",
                digits: int = 6) -> str:
    ps = ", ".join(f"round(max(CASE WHEN n = {k} THEN p END), 6) AS p{k}" for k in range(1, max_n + 1))
    return (f"SELECT round(CASE WHEN coalesce(min(p), 0) <= 0 THEN 0.0 ELSE any_value(bp) * exp(avg(CASE WHEN p > 0 THEN ln(p) END)) END, {digits}) AS {out}, "
            f"round(any_value(bp), 6) AS bp, {ps} FROM ("
            f"SELECT n, CASE WHEN {den} = 0 THEN 0.0 ELSE {num} / {den} END AS p, "
            f"CASE WHEN coalesce(max(CASE WHEN n = 1 THEN c_total END) OVER (), 0) = 0 THEN 0.0 "
            f"ELSE least(1.0, exp(1 - max(CASE WHEN n = 1 THEN r_total END) OVER () / max(CASE WHEN n = 1 THEN c_total END) OVER ())) END AS bp "
            f"FROM {per_order}) z")


def option_label(i: str, width: int = 7) -> str:
    """SQL twin of functions.prompts.option_label (0-based index i)."""
    n = f"({i} + 1)"
    digits = []
    for _ in range(width):
        digits.append(f"(CASE WHEN {n} > 0 THEN chr(CAST(65 + ({n} - 1) % 26 AS INTEGER)) ELSE '' END)")
        n = f"(CASE WHEN {n} > 0 THEN ({n} - 1) // 26 ELSE 0 END)"
    return " || ".join(reversed(digits))


# --------------------------------------------------------------- alignment

def aligned_words(pairs: str) -> str:
    """CTEs pr (k, a, b, ...) from a relation with token lists a and b, and their words by place."""
    return (f"pr AS (SELECT row_number() OVER () AS k, * FROM ({pairs})), "
            "wa AS (SELECT k, unnest(a) AS w, unnest(generate_series(1, len(a))) AS i FROM pr WHERE len(a) > 0), "
            "wb AS (SELECT k, unnest(b) AS w, unnest(generate_series(1, len(b))) AS j FROM pr WHERE len(b) > 0), "
            "wb0 AS (SELECT k, 0 AS j, NULL::VARCHAR AS w FROM pr UNION ALL SELECT k, j, w FROM wb)")


def alignment_rows(name: str, first: str, step: str, best: str) -> str:
    """Recursive CTE (k, i, j, d): row i of the table of a dynamic programme
    over word i of a. ``first`` is d of row 0, ``step`` d without the cell to
    the left (up: above, corner: above left, eq: the words are equal), and
    ``best`` the window that brings the left cells in."""
    return (f"{name} AS (SELECT k, 0 AS i, j, {first} AS d FROM wb0 UNION ALL "
            f"SELECT k, i, j, {best} AS d FROM (SELECT k, i, j, {step} AS t FROM ("
            f"SELECT r.k, r.i + 1 AS i, r.j, r.d AS up, lag(r.d) OVER (PARTITION BY r.k ORDER BY r.j) AS corner, wa.w = wb0.w AS eq "
            f"FROM {name} r JOIN wa ON wa.k = r.k AND wa.i = r.i + 1 JOIN wb0 ON wb0.k = r.k AND wb0.j = r.j) x) y)")


def distance_rows(name: str) -> str:
    """Edit distances d of all beginnings of a and b."""
    return alignment_rows(name, "j", "CASE WHEN j = 0 THEN i ELSE least(up + 1, corner + CASE WHEN eq THEN 0 ELSE 1 END) END",
                          "j + min(t - j) OVER (PARTITION BY k ORDER BY j)")


def common_rows(name: str) -> str:
    """Common subsequence lengths d of all beginnings of a and b."""
    return alignment_rows(name, "0", "CASE WHEN j > 0 AND eq THEN greatest(up, corner + 1) ELSE up END", "max(t) OVER (PARTITION BY k ORDER BY j)")


def alignment_value(name: str) -> str:
    """(k, d) of the whole of a and b."""
    return f"(SELECT pr.k, pr.a, pr.b, d FROM pr JOIN {name} USING (k) WHERE i = len(pr.a) AND j = len(pr.b))"

