"""DuckDB oracle SQL for the registered queries (same names, same columns).

Written independently of the Spark plans, at token level where the Spark side
works on arrays, so the two agree only if the semantics agree.
"""

from __future__ import annotations

from spindle import constants as C
from spindle.plans.catalog import BLOCKLIST_WORDS, VOCAB_SIZE

P = C.PRETOKEN_PATTERN
NL = "chr(10)"

# ---------------------------------------------------------------- shared CTEs
PRETOKENS = f"""
pt AS (
  SELECT doc_id, unnest(range(len(toks))) AS pos, unnest(toks) AS token
  FROM (SELECT doc_id, regexp_extract_all(text, '{P}') AS toks FROM documents)
)"""

VOCAB = f"""
wf AS (SELECT token, count(*) AS freq FROM pt GROUP BY token),
vw AS (
  SELECT CAST({C.FIRST_WORD_ID - 1} + row_number() OVER (ORDER BY freq DESC, token) AS BIGINT) AS token_id,
         token, 'word' AS kind, CAST(freq AS BIGINT) AS freq
  FROM wf
  QUALIFY row_number() OVER (ORDER BY freq DESC, token) <= {VOCAB_SIZE}
),
vb AS (
  SELECT CAST(b AS BIGINT) AS token_id,
         CASE WHEN b < 128 THEN chr(CAST(b AS INTEGER)) ELSE '�' END AS token,
         'byte' AS kind, CAST(0 AS BIGINT) AS freq
  FROM range(256) t(b)
),
vocab AS (
  SELECT * FROM vb
  UNION ALL SELECT {C.EOS_ID}, '{C.EOS_TEXT}', 'eos', 0
  UNION ALL SELECT * FROM vw
)"""


def _byte_ids(tok: str) -> str:
    return (f"list_transform(regexp_extract_all(hex(encode({tok})), '..'), "
            f"lambda h: CAST(('0x' || h) AS BIGINT))")


ENCODE_PIECES = f"""
ep AS (
  SELECT pt.doc_id, pt.pos,
         CASE WHEN vw.token_id IS NOT NULL THEN [vw.token_id] ELSE {_byte_ids('pt.token')} END AS ids
  FROM pt LEFT JOIN vw ON pt.token = vw.token
)"""

ENCODED = f"""
ed AS (
  SELECT d.doc_id, COALESCE(e.ids, []) AS ids
  FROM documents d
  LEFT JOIN (SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids FROM ep GROUP BY doc_id) e
  USING (doc_id)
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts)


CODEC = with_ctes(PRETOKENS, VOCAB, ENCODE_PIECES, ENCODED)

LINES = f"""
ln AS (
  SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id,
               regexp_extract_all(regexp_replace(text, '\\r\\n?', {NL}, 'g'), '[^\\n]*\\n|[^\\n]+') AS ls
        FROM documents)
)"""

# ---------------------------------------------------------------- queries
SQL: dict[str, str] = {}

SQL["scan_corpus"] = "SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM documents"

SQL["scan_text_lines"] = with_ctes(LINES) + """
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line FROM ln"""

SQL["join_lines"] = f"""
SELECT doc_id,
       CASE WHEN doc_id = (SELECT max(doc_id) FROM documents) THEN text ELSE text || {NL} END AS text
FROM documents"""

SQL["scan_prompts"] = """
SELECT conv_id || ':' || turn AS seq_id, text
FROM conversations WHERE role = 'user'"""

_stem = r"regexp_replace(string_split(url, '/')[-1], '^(\.*[^.].*)\.[^.]*$', '\1')"
SQL["dataset_tag"] = f"""
SELECT page_id, url,
       CASE url WHEN 'tiny-shakespeare' THEN 'tinyshakes' WHEN 'wikitext-103' THEN 'wikitext103'
                WHEN 'bookcorpus' THEN 'bookcorpus' ELSE substring({_stem}, 1, {C.TAG_LENGTH}) END AS tag
FROM pages"""

SQL["pretokenize"] = with_ctes(PRETOKENS) + """
SELECT doc_id, CAST(pos AS BIGINT) AS pos, token FROM pt"""

SQL["build_vocab"] = with_ctes(PRETOKENS, VOCAB) + """
SELECT token_id, token, kind, freq FROM vocab"""

SQL["encode"] = CODEC + """
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_ids, array_to_string(ids, ' ') AS ids FROM ed"""

SQL["decode_token"] = CODEC + """
SELECT v.token_id, v.token AS token_text, u.n_uses
FROM (SELECT CAST(unnest(ids) AS BIGINT) AS token_id FROM ed) x
JOIN vocab v USING (token_id)
JOIN (SELECT token_id, count(*) AS n_uses FROM (SELECT unnest(ids) AS token_id FROM ed) GROUP BY 1) u
  USING (token_id)
GROUP BY v.token_id, v.token, u.n_uses"""

# decode(encode(text)) = text is the contract; the oracle is the input itself.
SQL["decode_seq"] = "SELECT doc_id, text FROM documents"

SQL["token_counts"] = CODEC + """
SELECT d.doc_id, CAST(len(regexp_extract_all(d.text, '""" + P + """')) AS BIGINT) AS n_pretokens,
       CAST(len(ed.ids) AS BIGINT) AS n_ids
FROM documents d JOIN ed USING (doc_id)"""

SQL["encode_lines"] = with_ctes(PRETOKENS, VOCAB, LINES) + f""",
lt AS (
  SELECT doc_id, line_no, unnest(range(len(toks))) AS pos, unnest(toks) AS token
  FROM (SELECT doc_id, line_no, regexp_extract_all(line, '{P}') AS toks FROM ln)
),
le AS (
  SELECT lt.doc_id, lt.line_no, lt.pos,
         CASE WHEN vw.token_id IS NOT NULL THEN [vw.token_id] ELSE {_byte_ids('lt.token')} END AS ids
  FROM lt LEFT JOIN vw ON lt.token = vw.token
)
SELECT ln.doc_id, CAST(ln.line_no AS BIGINT) AS line_no,
       CAST(len(COALESCE(x.ids, [])) AS BIGINT) AS n_ids, array_to_string(COALESCE(x.ids, []), ' ') AS ids
FROM ln LEFT JOIN (SELECT doc_id, line_no, flatten(list(ids ORDER BY pos)) AS ids FROM le GROUP BY 1, 2) x
  USING (doc_id, line_no)"""

# ---------------------------------------------------------------- packing
from spindle.plans.catalog import EPOCHS, SLIDE_SIZE, SLIDE_STRIDE, STEPS  # noqa: E402

B, R = C.BLOCK_SIZE, C.BATCH_SIZE
BR = B * R

STREAM = f"""
offs AS (
  SELECT doc_id, CAST(len(ids) AS BIGINT) AS n,
         CAST(COALESCE(sum(len(ids)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS BIGINT) AS "offset"
  FROM ed
),
st AS (
  SELECT s.doc_id, CAST(s.pos AS BIGINT) AS pos, CAST(o."offset" + s.pos AS BIGINT) AS gpos,
         CAST(s.token_id AS BIGINT) AS token_id
  FROM (SELECT doc_id, unnest(range(len(ids))) AS pos, unnest(ids) AS token_id FROM ed) s
  JOIN offs o USING (doc_id)
),
tot AS (SELECT CAST(count(*) AS BIGINT) AS total FROM st),
blk AS (
  SELECT gpos // {B} AS block, list(token_id ORDER BY gpos) AS x FROM st GROUP BY 1
),
nfull AS (SELECT total // {BR} AS n_full FROM tot),
fullb AS (
  SELECT block // {R} AS step, block % {R} AS "row", x FROM blk, nfull WHERE block < n_full * {R}
)"""

PACK = CODEC + "," + STREAM


def _bout(cols="step, \"row\"", src="fullb"):
    return f"""
SELECT {cols}, CAST(len(x) AS BIGINT) AS n, array_to_string(x, ' ') AS x FROM {src}"""


SQL["token_offsets"] = PACK + """
SELECT doc_id, n AS n_ids, "offset" FROM offs"""

SQL["concat_stream"] = PACK + """
SELECT doc_id, pos, gpos, token_id FROM st"""

SQL["pack_blocks"] = PACK + f"""
SELECT block, block // {R} AS step, block % {R} AS "row", CAST(len(x) AS BIGINT) AS n,
       array_to_string(x, ' ') AS x FROM blk"""

SQL["reshape_rows"] = PACK + f"""
SELECT gpos, token_id, gpos // {BR} AS step, (gpos % {BR}) // {B} AS "row", gpos % {B} AS col FROM st"""

SQL["drop_remainder"] = PACK + _bout()

WRAP = f""",
wrap AS (
  SELECT CAST(r.k AS BIGINT) AS step, f."row", f.x
  FROM range({STEPS}) r(k), nfull JOIN fullb f ON f.step = r.k % nfull.n_full
)"""
SQL["pack_wrap"] = PACK + WRAP + _bout(src="wrap")

SQL["pack_carry"] = PACK + f""",
rep AS (
  SELECT st.gpos + p.pass * tot.total AS g, st.token_id
  FROM st, tot, range(CAST(ceil({STEPS * BR} / tot.total) AS BIGINT)) p(pass)
),
carry AS (
  SELECT (g // {B}) // {R} AS step, (g // {B}) % {R} AS "row", list(token_id ORDER BY g) AS x
  FROM rep WHERE g < {STEPS * BR} GROUP BY 1, 2
)""" + _bout(src="carry")

SQL["steps_per_epoch"] = PACK + f""",
capped AS (SELECT * FROM fullb WHERE step < {STEPS})""" + _bout(src="capped")

SQL["epochs"] = PACK + WRAP + f""",
epx AS (SELECT CAST(e.epoch AS BIGINT) AS epoch, w.* FROM range(1, {EPOCHS + 1}) e(epoch), wrap w)""" + \
    _bout('epoch, step, "row"', "epx")

SQL["training_pairs"] = PACK + f""",
nb AS (SELECT ((total - 1) // {BR}) * {R} AS nb FROM tot),
xb AS (SELECT gpos // {B} AS block, list(token_id ORDER BY gpos) AS x FROM st, nb
       WHERE gpos < nb.nb * {B} GROUP BY 1),
yb AS (SELECT (gpos - 1) // {B} AS block, list(token_id ORDER BY gpos) AS y FROM st, nb
       WHERE gpos >= 1 AND gpos - 1 < nb.nb * {B} GROUP BY 1)
SELECT xb.block // {R} AS step, xb.block % {R} AS "row",
       array_to_string(x, ' ') AS x, array_to_string(y, ' ') AS y
FROM xb JOIN yb USING (block)"""

SQL["training_pairs_same"] = PACK + """
SELECT step, "row", array_to_string(x, ' ') AS x, array_to_string(x, ' ') AS y FROM fullb"""

SQL["sliding_blocks"] = PACK + f""",
win AS (
  SELECT w AS "window", list(token_id ORDER BY gpos) AS x
  FROM (SELECT st.gpos, st.token_id,
               unnest(range(greatest(0, CAST(ceil((st.gpos - {SLIDE_SIZE - 1}) / {SLIDE_STRIDE}) AS BIGINT)),
                            least(st.gpos // {SLIDE_STRIDE}, (tot.total - {SLIDE_SIZE}) // {SLIDE_STRIDE}) + 1))
                 AS w
        FROM st, tot)
  GROUP BY 1
)""" + _bout('"window"', "win")

PROMPT_PARTS = f"""
pr AS (SELECT conv_id || ':' || turn AS seq_id, text FROM conversations WHERE role = 'user'),
ppt AS (
  SELECT seq_id, unnest(range(len(toks))) AS pos, unnest(toks) AS token
  FROM (SELECT seq_id, regexp_extract_all(text, '{P}') AS toks FROM pr)
),
pep AS (
  SELECT ppt.seq_id, ppt.pos,
         CASE WHEN vw.token_id IS NOT NULL THEN [vw.token_id] ELSE {_byte_ids('ppt.token')} END AS ids
  FROM ppt LEFT JOIN vw ON ppt.token = vw.token
),
pe AS (
  SELECT pr.seq_id, COALESCE(x.ids, []) AS ids
  FROM pr LEFT JOIN (SELECT seq_id, flatten(list(ids ORDER BY pos)) AS ids FROM pep GROUP BY 1) x USING (seq_id)
)"""
PROMPT_CODEC = with_ctes(PRETOKENS, VOCAB) + "," + PROMPT_PARTS

SQL["truncate_context"] = PROMPT_CODEC + f"""
SELECT seq_id, CAST(len(ids) AS BIGINT) AS n_ids,
       array_to_string(CASE WHEN len(ids) > {B} THEN ids[len(ids) - {B} + 1:] ELSE ids END, ' ') AS ctx
FROM pe"""

# ---------------------------------------------------------------- blocklist
from spindle.plans.catalog import (FIXTURE_BLOCKED, FIXTURE_EOS, SEED,  # noqa: E402
                                   TOP_P_FIXTURE)

_words = ", ".join(f"('{w}')" for w in BLOCKLIST_WORDS)
BL = f"""
bl AS (SELECT DISTINCT lower(word) AS word FROM (VALUES {_words}) t(word)
       WHERE word IS NOT NULL AND length(word) > 0)"""

SQL["blocked_token_ids"] = with_ctes(PRETOKENS, VOCAB, BL) + """
SELECT token_id, token FROM vocab v
WHERE EXISTS (SELECT 1 FROM bl WHERE contains(regexp_replace(lower(v.token), '^\\s+', ''), bl.word))"""

SQL["blocked_rate"] = with_ctes(PRETOKENS, BL) + """,
bt AS (SELECT token FROM (SELECT DISTINCT token FROM pt) d
       WHERE EXISTS (SELECT 1 FROM bl WHERE contains(regexp_replace(lower(d.token), '^\\s+', ''), bl.word)))
SELECT d.doc_id, CAST(count(pt.token) AS BIGINT) AS n_pretokens,
       CAST(count(bt.token) AS BIGINT) AS n_blocked,
       CASE WHEN count(pt.token) > 0 THEN round(count(bt.token) / count(pt.token), 6) END AS blocked_rate,
       CAST(any_value(l.toxic) AS BIGINT) AS toxic
FROM documents d LEFT JOIN pt USING (doc_id) LEFT JOIN bt USING (token) LEFT JOIN labels l ON l.doc_id = d.doc_id
GROUP BY d.doc_id"""

# ---------------------------------------------------------------- score chain
_blocked = ", ".join(str(i) for i in FIXTURE_BLOCKED)
NEG = "CAST('-inf' AS DOUBLE)"


def chain_sql(base: str, seqs: str, blocked: str, seed: int = SEED, step: int = 0,
              top_k: int = C.TOP_K, top_p: float = TOP_P_FIXTURE,
              kept: str = "s_topk") -> str:
    """CTEs s_temp .. s_draw over ``base(seq_id, token_id, score)`` and ``seqs(seq_id, ids)``;
    ``blocked`` is a SQL set of blocked ids. The draw is from ``kept`` (s_topk or s_topp)."""
    return f""",
bans AS (
  SELECT DISTINCT seq_id, g[3] AS token_id
  FROM (SELECT seq_id, ids, unnest(list_transform(range(len(ids) - 2), lambda i: ids[i + 1:i + 3])) AS g
        FROM {seqs} WHERE len(ids) >= 3)
  WHERE g[1:2] = ids[-2:]
),
s_temp AS (SELECT seq_id, token_id, score / {C.TEMPERATURE} AS score FROM {base}),
s_mask AS (SELECT seq_id, token_id, CASE WHEN token_id IN {blocked} THEN {NEG} ELSE score END AS score
           FROM s_temp),
s_ngram AS (SELECT s.seq_id, s.token_id, CASE WHEN b.token_id IS NOT NULL THEN {NEG} ELSE s.score END AS score
            FROM s_mask s LEFT JOIN bans b USING (seq_id, token_id)),
s_pen AS (SELECT s.seq_id, s.token_id,
                 CASE WHEN list_contains(q.ids, s.token_id)
                      THEN CASE WHEN s.score < 0 THEN s.score * {C.REPETITION_PENALTY}
                                ELSE s.score / {C.REPETITION_PENALTY} END
                      ELSE s.score END AS score
          FROM s_ngram s JOIN {seqs} q USING (seq_id)),
s_soft AS (
  SELECT seq_id, token_id, e / sum(e) OVER (PARTITION BY seq_id) AS p
  FROM (SELECT seq_id, token_id,
               CASE WHEN max(score) OVER (PARTITION BY seq_id) = {NEG} THEN 0.0
                    ELSE exp(score - max(score) OVER (PARTITION BY seq_id)) END AS e
        FROM s_pen)
),
s_sup0 AS (SELECT s.seq_id, s.token_id, CASE WHEN s.token_id = q.ids[-1] THEN 0.0 ELSE s.p END AS p
           FROM s_soft s JOIN {seqs} q USING (seq_id)),
s_sup AS (SELECT seq_id, token_id,
                 CASE WHEN sum(p) OVER (PARTITION BY seq_id) > 0 THEN p / sum(p) OVER (PARTITION BY seq_id)
                      ELSE 0.0 END AS p FROM s_sup0),
s_rank AS (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY p DESC, token_id) AS rank,
                  sum(p) OVER (PARTITION BY seq_id ORDER BY p DESC, token_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
           FROM s_sup),
s_topk AS (SELECT seq_id, token_id, rank, p / sum(p) OVER (PARTITION BY seq_id) AS p FROM s_rank
           WHERE rank <= {top_k}),
s_topp AS (SELECT seq_id, token_id, rank, p / sum(p) OVER (PARTITION BY seq_id) AS p FROM s_rank
           WHERE cum <= {top_p} OR rank = 1),
s_draw AS (
  SELECT seq_id,
         CASE WHEN sum(p) > 0 THEN
           COALESCE(arg_min(token_id, rank) FILTER (WHERE cum > u), arg_max(token_id, rank) FILTER (WHERE p > 0)) END AS token_id,
         any_value(u) AS u
  FROM (SELECT *, sum(p) OVER (PARTITION BY seq_id ORDER BY p DESC, token_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
               CAST(('0x' || substr(md5(concat_ws('|', {seed}, seq_id, {step})), 1, 13)) AS BIGINT)
                 / 4503599627370496.0 AS u
        FROM {kept})
  GROUP BY seq_id
)"""


CHAIN = f"""
WITH sc0 AS (
  SELECT CAST(vec_id AS BIGINT) AS seq_id, CAST(unnest(range(len(embedding))) AS BIGINT) AS token_id,
         CAST(unnest(embedding) AS DOUBLE) * 10 AS score
  FROM embeddings
),
sq AS (
  SELECT CAST(vec_id AS BIGINT) AS seq_id, list_transform(range(8), lambda i: (vec_id + i % 3) % 64) AS ids
  FROM embeddings
)""" + chain_sql("sc0", "sq", f"({_blocked})")

SQL["temperature"] = CHAIN + "\nSELECT seq_id, token_id, round(score, 6) AS score FROM s_temp"
SQL["mask_blocked"] = CHAIN + "\nSELECT seq_id, token_id, round(score, 6) AS score FROM s_mask"
SQL["no_repeat_ngram"] = CHAIN + "\nSELECT seq_id, token_id, round(score, 6) AS score FROM s_ngram"
SQL["repetition_penalty"] = CHAIN + "\nSELECT seq_id, token_id, round(score, 6) AS score FROM s_pen"
SQL["softmax"] = CHAIN + "\nSELECT seq_id, token_id, round(p, 6) AS p FROM s_soft"
SQL["suppress_last"] = CHAIN + "\nSELECT seq_id, token_id, round(p, 6) AS p FROM s_sup"
SQL["top_k"] = CHAIN + "\nSELECT seq_id, token_id, rank, round(p, 6) AS p FROM s_topk"
SQL["top_p"] = CHAIN + "\nSELECT seq_id, token_id, rank, round(p, 6) AS p FROM s_topp"
SQL["greedy"] = CHAIN + "\nSELECT seq_id, token_id FROM s_rank WHERE rank = 1"
SQL["sample_token"] = CHAIN + "\nSELECT seq_id, token_id, round(u, 12) AS u FROM s_draw"
SQL["append_token"] = CHAIN + """
SELECT q.seq_id, CAST(len(q.ids) + 1 AS BIGINT) AS n_ids, array_to_string(list_append(q.ids, d.token_id), ' ') AS ids
FROM sq q JOIN s_draw d USING (seq_id)"""
SQL["stop_rule"] = CHAIN + f"""
SELECT seq_id, token_id,
       CASE WHEN token_id = {FIXTURE_EOS} THEN 'eos' WHEN 1 >= {C.MAX_NEW_TOKENS} THEN 'max_new' END AS reason
FROM s_draw"""
SQL["processor_chain"] = SQL["top_k"]

# ---------------------------------------------------------------- count model
L3, L2, L1, L0 = C.LAMBDA_3, C.LAMBDA_2, C.LAMBDA_1, C.LAMBDA_0

MODEL = f""",
wpos AS (
  SELECT step, "row", CAST(unnest(range(len(x))) AS BIGINT) AS i, unnest(x) AS w FROM fullb
),
wctx AS (
  SELECT step, "row", i, w,
         lag(w, 2) OVER (PARTITION BY step, "row" ORDER BY i) AS u,
         lag(w, 1) OVER (PARTITION BY step, "row" ORDER BY i) AS v
  FROM wpos
),
grams AS (
  SELECT 1 AS ord, -1 AS u, -1 AS v, w FROM wctx
  UNION ALL SELECT 2, -1, v, w FROM wctx WHERE v IS NOT NULL
  UNION ALL SELECT 3, u, v, w FROM wctx WHERE u IS NOT NULL
),
model AS (SELECT ord, u, v, w, count(*) AS cnt FROM grams GROUP BY ALL),
m3 AS (SELECT u, v, w, cnt AS n3 FROM model WHERE ord = 3),
mt3 AS (SELECT u, v, sum(n3) AS t3 FROM m3 GROUP BY ALL),
m2 AS (SELECT v, w, cnt AS n2 FROM model WHERE ord = 2),
mt2 AS (SELECT v, sum(n2) AS t2 FROM m2 GROUP BY ALL),
m1 AS (SELECT w, cnt AS n1 FROM model WHERE ord = 1),
mt1 AS (SELECT sum(n1) AS t1 FROM m1),
nv AS (SELECT count(*) AS n_ids FROM vocab)"""


def p_expr(n3="n3", t3="t3", n2="n2", t2="t2", n1="n1", t1="t1", nids="n_ids"):
    return f"""(
  (CASE WHEN COALESCE({t3}, 0) > 0 THEN {L3} * COALESCE({n3}, 0) / {t3} ELSE 0.0 END
   + CASE WHEN COALESCE({t2}, 0) > 0 THEN {L2} * COALESCE({n2}, 0) / {t2} ELSE 0.0 END
   + {L1} * COALESCE({n1}, 0) / {t1} + {L0} / CAST({nids} AS DOUBLE))
  / (CASE WHEN COALESCE({t3}, 0) > 0 THEN {L3} ELSE 0.0 END
     + CASE WHEN COALESCE({t2}, 0) > 0 THEN {L2} ELSE 0.0 END + {L1} + {L0}))"""


_model_cols = "CAST(ord AS BIGINT) AS ord, CAST(u AS BIGINT) AS u, CAST(v AS BIGINT) AS v, " \
              "CAST(w AS BIGINT) AS w, CAST(cnt AS BIGINT) AS cnt"
SQL["train_ngrams"] = PACK + MODEL + f"\nSELECT {_model_cols} FROM model"
SQL["resume_train"] = SQL["train_ngrams"]

SQL["cross_entropy"] = PACK + MODEL + f"""
SELECT CAST(c.step AS BIGINT) AS step,
       round(avg(-ln({p_expr()})), 6) AS loss
FROM wctx c
LEFT JOIN m3 ON m3.u = c.u AND m3.v = c.v AND m3.w = c.w
LEFT JOIN mt3 ON mt3.u = c.u AND mt3.v = c.v
LEFT JOIN m2 ON m2.v = c.v AND m2.w = c.w
LEFT JOIN mt2 ON mt2.v = c.v
LEFT JOIN m1 ON m1.w = c.w, mt1, nv
GROUP BY c.step"""

RUNNING = f"""
WITH r AS (
  SELECT event_type, event_id, value AS loss,
         CASE WHEN count(value) OVER w = {C.LOSS_WINDOW} THEN avg(value) OVER w END AS mean_loss
  FROM events
  WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN {C.LOSS_WINDOW - 1} PRECEDING AND CURRENT ROW)
)"""
SQL["running_mean_loss"] = RUNNING + """
SELECT event_type, event_id, loss, round(mean_loss, 6) AS mean_loss FROM r"""
SQL["format_loss"] = RUNNING + """
SELECT event_type, event_id,
       CASE WHEN mean_loss IS NOT NULL THEN printf('%.10f', loss) ELSE printf('%.4f', loss) END AS raw_loss_text,
       CASE WHEN mean_loss IS NOT NULL THEN printf('%.10f', mean_loss) ELSE 'n/a' END AS mean_loss_text
FROM r"""

# ---------------------------------------------------------------- completion
GEN = PACK + MODEL + "," + PROMPT_PARTS + f""",
ctxp AS (
  SELECT seq_id, ids, CASE WHEN len(ids) >= 2 THEN ids[-2] END AS u, ids[-1] AS v
  FROM pe WHERE len(ids) > 0
),
dense AS (SELECT c.seq_id, CAST(r.t AS BIGINT) AS token_id, c.u, c.v FROM ctxp c, nv, range(nv.n_ids) r(t)),
nts AS (
  SELECT d.seq_id, d.token_id, ln({p_expr()}) AS score
  FROM dense d
  LEFT JOIN m3 ON m3.u = d.u AND m3.v = d.v AND m3.w = d.token_id
  LEFT JOIN mt3 ON mt3.u = d.u AND mt3.v = d.v
  LEFT JOIN m2 ON m2.v = d.v AND m2.w = d.token_id
  LEFT JOIN mt2 ON mt2.v = d.v
  LEFT JOIN m1 ON m1.w = d.token_id, mt1, nv
),
""" + BL + """,
blkd AS (
  SELECT token_id FROM vocab v
  WHERE EXISTS (SELECT 1 FROM bl WHERE contains(regexp_replace(lower(v.token), '^\\s+', ''), bl.word))
)"""

SQL["next_token_scores"] = GEN + """
SELECT seq_id, token_id, round(score, 6) AS score FROM nts"""

_step_out = f"""
SELECT p.seq_id,
       CAST(CASE WHEN len(p.ids) = 0 THEN 0 WHEN d.token_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_new,
       CAST(CASE WHEN len(p.ids) = 0 THEN NULL WHEN d.token_id IS NULL THEN p.ids[-1] ELSE d.token_id END
            AS BIGINT) AS last_id,
       CASE WHEN len(p.ids) = 0 THEN 'empty_prompt'
            WHEN d.token_id IS NULL THEN 'no_candidate'
            WHEN d.token_id = {C.EOS_ID} THEN 'eos'
            WHEN 1 >= {C.MAX_NEW_TOKENS} THEN 'max_new' END AS reason
FROM pe p LEFT JOIN s_draw d USING (seq_id)"""
SQL["generate_step"] = GEN + chain_sql("nts", "ctxp", "(SELECT token_id FROM blkd)") + _step_out
SQL["nucleus_step"] = GEN + chain_sql("nts", "ctxp", "(SELECT token_id FROM blkd)", kept="s_topp") + _step_out

# ---------------------------------------------------------------- sinks / streams
SQL["sink_metrics"] = PACK + MODEL + f""",
ce AS (
  SELECT c.step, avg(-ln({p_expr()})) AS loss
  FROM wctx c
  LEFT JOIN m3 ON m3.u = c.u AND m3.v = c.v AND m3.w = c.w
  LEFT JOIN mt3 ON mt3.u = c.u AND mt3.v = c.v
  LEFT JOIN m2 ON m2.v = c.v AND m2.w = c.w
  LEFT JOIN mt2 ON mt2.v = c.v
  LEFT JOIN m1 ON m1.w = c.w, mt1, nv
  GROUP BY c.step
)
SELECT 'run0' AS run, CAST(1 AS BIGINT) AS epoch, CAST(step AS BIGINT) AS step, round(loss, 6) AS loss,
       round(CASE WHEN count(loss) OVER w = {C.LOSS_WINDOW} THEN avg(loss) OVER w END, 6) AS mean_loss
FROM ce
WINDOW w AS (ORDER BY step ROWS BETWEEN {C.LOSS_WINDOW - 1} PRECEDING AND CURRENT ROW)"""

SQL["save_model"] = SQL["train_ngrams"]
SQL["load_model"] = PACK + MODEL + f"""
SELECT {_model_cols.replace("CAST(cnt AS BIGINT)", "CAST(2 * cnt AS BIGINT)")} FROM model"""
SQL["stream_corpus"] = "SELECT doc_id, text FROM documents"
SQL["stream_pack"] = SQL["drop_remainder"]
SQL["train_stream"] = SQL["train_ngrams"]


def completion(max_new: int) -> str:
    """CTE ``final``: every prompt completed, one id a round. The draw needs no softmax over
    all ids: renormalising the top k takes its denominator out. Candidates are a prompt's own
    ids, all followers of its last id and, as many as could be pushed out, the most frequent."""
    return GEN.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
one AS MATERIALIZED (SELECT mt1.t1, nv.n_ids FROM mt1, nv),
d1 AS MATERIALIZED (
  SELECT CAST(r.t AS BIGINT) AS w, COALESCE(m1.n1, 0) AS n1, row_number() OVER (ORDER BY COALESCE(m1.n1, 0) DESC, r.t) AS place
  FROM one, range(one.n_ids) r(t) LEFT JOIN m1 ON m1.w = r.t
  WHERE r.t NOT IN (SELECT token_id FROM blkd)),
c3 AS MATERIALIZED (SELECT u, v, w, n3, t3 FROM m3 JOIN mt3 USING (u, v)),
c2 AS MATERIALIZED (SELECT v, w, n2, t2 FROM m2 JOIN mt2 USING (v)),
k3 AS MATERIALIZED (SELECT * FROM mt3), k2 AS MATERIALIZED (SELECT * FROM mt2),
gen AS (
  SELECT CAST(seq_id AS VARCHAR) AS seq_id, 0 AS n_new, CAST(ids AS BIGINT[]) AS ids, CAST(len(ids) AS BIGINT) AS prompt_len,
         CASE WHEN len(ids) = 0 THEN 'empty_prompt' END AS reason
  FROM pe
  UNION ALL
  (WITH g AS (
     SELECT gen.*, k3.t3, k2.t2, one.t1, one.n_ids,
            list_transform(list_filter(range(1, len(ids) - 1), lambda i: ids[i] = ids[-2] AND ids[i + 1] = ids[-1]),
                           lambda i: ids[i + 2]) AS bans,
            CAST(('0x' || substr(md5(concat_ws('|', {SEED}, seq_id, n_new)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
     FROM gen LEFT JOIN k3 ON k3.u = gen.ids[-2] AND k3.v = gen.ids[-1] LEFT JOIN k2 ON k2.v = gen.ids[-1], one
     WHERE reason IS NULL)
  SELECT seq_id, CASE WHEN nxt IS NULL THEN n_new ELSE n_new + 1 END,
         CASE WHEN nxt IS NULL THEN ids ELSE list_append(ids, nxt) END, prompt_len,
         CASE WHEN nxt IS NULL THEN 'no_candidate' WHEN nxt = {C.EOS_ID} THEN 'eos'
              WHEN n_new + 1 >= {max_new} THEN 'max_new' END
  FROM (
    SELECT seq_id, n_new, ids, prompt_len,
           -top[COALESCE(list_position(list_transform(run, lambda c: c > u * run[-1]), true), len(top))].m AS nxt
    FROM (
      SELECT *, list_transform(range(1, len(top) + 1), lambda i: list_sum(list_transform(top[:i], lambda x: x.e))) AS run
      FROM (
        SELECT seq_id, any_value(n_new) AS n_new, any_value(ids) AS ids, any_value(prompt_len) AS prompt_len, any_value(u) AS u,
               max({{'e': e, 'm': -w}}, {C.TOP_K}) FILTER (WHERE e > 0) AS top
        FROM (
          SELECT seq_id, n_new, ids, prompt_len, u, w,
                 CASE WHEN w = ids[-1] OR list_contains(bans, w) THEN 0.0
                      ELSE exp(CASE WHEN list_contains(ids, w) THEN CASE WHEN s < 0 THEN s * {C.REPETITION_PENALTY}
                               ELSE s / {C.REPETITION_PENALTY} END ELSE s END) END AS e
          FROM (
            SELECT g.seq_id, g.n_new, g.ids, g.prompt_len, g.u, g.bans, d1.w,
                   ln({p_expr("c3.n3", "g.t3", "c2.n2", "g.t2", "d1.n1", "g.t1", "g.n_ids")}) / {C.TEMPERATURE} AS s
            FROM g JOIN (
              SELECT seq_id, unnest(ids) AS w FROM g
              UNION SELECT g.seq_id, c2.w FROM g JOIN c2 ON c2.v = g.ids[-1]
              UNION SELECT g.seq_id, d1.w FROM g JOIN d1 ON d1.place <= {C.TOP_K} + len(g.ids)) cand USING (seq_id)
            JOIN d1 ON d1.w = cand.w
            LEFT JOIN c3 ON c3.u = g.ids[-2] AND c3.v = g.ids[-1] AND c3.w = d1.w
            LEFT JOIN c2 ON c2.v = g.ids[-1] AND c2.w = d1.w))
        GROUP BY seq_id))))
),
final AS (SELECT * FROM gen WHERE reason IS NOT NULL)"""


SQL["complete_batch"] = completion(C.MAX_NEW_TOKENS) + f""",
said AS (
  SELECT seq_id, string_agg(CASE WHEN token_id < {C.N_BYTES} THEN printf('%02X', token_id) ELSE hex(encode(token)) END, '' ORDER BY i) AS hex
  FROM (SELECT seq_id, unnest(range(n_new)) AS i, unnest(ids[prompt_len + 1:]) AS token_id FROM final WHERE n_new > 0)
  JOIN vocab USING (token_id) GROUP BY seq_id)
SELECT seq_id, CAST(n_new AS BIGINT) AS n_new, reason, array_to_string(ids, ' ') AS ids, COALESCE(hex, '') AS continuation_hex
FROM final LEFT JOIN said USING (seq_id)"""

from spindle.plans.catalog import STREAM_MAX_NEW  # noqa: E402

SQL["complete_stream"] = completion(STREAM_MAX_NEW) + """
SELECT seq_id, CAST(n_new AS BIGINT) AS n_new, reason, array_to_string(ids, ' ') AS ids FROM final"""

SQL["sink_completions"] = completion(STREAM_MAX_NEW) + """
SELECT seq_id, CAST(i AS BIGINT) AS step, CAST(n.token_id AS BIGINT) AS token_id, v.token AS token_text
FROM (SELECT seq_id, unnest(range(len(ids) - prompt_len)) AS i, unnest(ids[prompt_len + 1:]) AS token_id
      FROM final WHERE n_new > 0) n JOIN vocab v ON v.token_id = n.token_id"""

# ---------------------------------------------------------------- BPE
from spindle.plans.catalog import BPE_MERGES  # noqa: E402

# Symbols of a word, each between spaces of its own (" 61  62 "): a merge is one plain
# replacement, leftmost first. One merge a round: all pairs are counted anew, the words
# that hold the best one are replaced by their key (0, word), the merge is row (rank + 1, '').
BPE_LEARN = "WITH RECURSIVE " + with_ctes(PRETOKENS).removeprefix("WITH ") + f""",
w0 AS MATERIALIZED (
  SELECT token AS word, count(*) AS freq,
         ' ' || array_to_string(regexp_extract_all(hex(encode(token)), '..'), '  ') || ' ' AS syms
  FROM pt GROUP BY token),
st(k, word, rank, freq, syms, a, b) USING KEY (k, word) AS (
  SELECT CAST(0 AS BIGINT), word, CAST(-1 AS BIGINT), CAST(freq AS BIGINT), syms, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
  FROM w0
  UNION
  (WITH words AS MATERIALIZED (SELECT word, freq, syms FROM recurring.st WHERE k = 0),
  best AS MATERIALIZED (
    SELECT z.a || ' ' || z.b AS pair, z.a AS a, z.b AS b, CAST(sum(freq) AS BIGINT) AS n
    FROM (SELECT freq, unnest(list_transform(range(1, len(s)), lambda i: {{'a': s[i], 'b': s[i + 1]}})) AS z
          FROM (SELECT freq, string_split(trim(syms), '  ') AS s FROM words))
    GROUP BY ALL ORDER BY n DESC, pair LIMIT 1),
  step AS (SELECT CAST(max(rank) + 1 AS BIGINT) AS r FROM st)
  SELECT CAST(0 AS BIGINT), word, r, freq, replace(syms, ' ' || a || '  ' || b || ' ', ' ' || a || b || ' '), NULL, NULL
  FROM words, best, step WHERE r < {BPE_MERGES} AND contains(syms, ' ' || a || '  ' || b || ' ')
  UNION ALL
  SELECT r + 1, '', r, n, '', a, b FROM best, step WHERE r < {BPE_MERGES})),
merges AS MATERIALIZED (SELECT rank, a, b, freq FROM st WHERE k > 0),
w AS MATERIALIZED (SELECT word, syms FROM st WHERE k = 0)"""

SQL["learn_merges"] = BPE_LEARN + "\nSELECT rank, a, b, freq FROM merges"
SQL["bpe_encode"] = BPE_LEARN + f""",
sym AS (SELECT a || b AS s, {C.FIRST_WORD_ID} + max(rank) AS id FROM merges GROUP BY ALL),
ws AS (SELECT word, unnest(range(len(p))) AS i, unnest(p) AS s
       FROM (SELECT word, string_split(trim(syms), '  ') AS p FROM w)),
wi AS (SELECT word, list(CASE WHEN length(ws.s) = 2 THEN CAST('0x' || ws.s AS BIGINT) ELSE sym.id END ORDER BY i) AS ids
       FROM ws LEFT JOIN sym USING (s) GROUP BY word),
de AS (SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids FROM pt JOIN wi ON pt.token = wi.word GROUP BY doc_id)
SELECT d.doc_id, CAST(len(COALESCE(ids, [])) AS BIGINT) AS n_ids, array_to_string(COALESCE(ids, []), ' ') AS ids
FROM documents d LEFT JOIN de USING (doc_id)"""
