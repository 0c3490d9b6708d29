"""SQL counterparts of the queries, in DuckDB's dialect."""

from __future__ import annotations

# Fixed values of the workload, told here once more and not taken from the code under test.
CHUNK_TOKENS, CHUNK_OVERLAP = 240, 60
SWEEP = ((160, 40), (200, 50), (240, 60))
LOG_PREFIX_CHARS = 200
PREVIEW_CHARS = 50
MAX_PROMPT_TOKENS = 2048
NO_TITLE = "No Title"
# The instruction texts.
CLOSING = "Give only the final answer as a short phrase (no explanation, no full sentence)."
_SYSTEM = (
    "You are a question answering assistant for a trivia dataset. "
    "Use the information in the passages to answer the question. "
    "Prefer short, factual answers. "
)


def instruction(vote: bool) -> str:
    if vote:
        return _SYSTEM + "If the passages do not clearly contain the answer, you may answer based on your own knowledge."
    return _SYSTEM + "If the passages do not clearly contain the answer, answer it based on your own knowledge. "


_BLANKS = r"[ \t\n\r]+"
_BREAKS = r"[ \t\n\r!-/:-@\[-`{-~]+"
_UNICODE_BLANKS = r"[\x09-\x0d\x1c-\x20\x{85}\pZ]+"
_PUNCTUATION = r"[!-/:-@\[-`{-~]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _kept(items: str) -> str:
    return f"list_filter({items}, lambda kept: kept <> '')"


def _tokens(text: str) -> str:
    return _kept(f"string_split_regex({text}, '{_BLANKS}')")


def _words(text: str) -> str:
    return _kept(f"string_split_regex(lower({text}), '{_BREAKS}')")


def _pieces(text: str, pattern: str) -> str:
    return _kept(f"list_transform(string_split_regex({text}, '{pattern}'), lambda piece: trim(piece))")


def _squeeze(text: str) -> str:
    return f"trim(regexp_replace({text}, '{_UNICODE_BLANKS}', ' ', 'g'))"


def _answer_words(text: str) -> str:
    bare = f"regexp_replace(lower({text}), '{_PUNCTUATION}', '', 'g')"
    return (
        f"list_filter(string_split_regex({bare}, '{_UNICODE_BLANKS}'), "
        "lambda aw: aw NOT IN ('', 'a', 'an', 'the'))"
    )


def _normal(text: str) -> str:
    return f"array_to_string({_answer_words(text)}, ' ')"


def _vote_key(text: str) -> str:
    edges = f"regexp_replace({text}, '^{_UNICODE_BLANKS}|{_UNICODE_BLANKS}$', '', 'g')"
    bare = f"lower(trim({edges}, '\"'''))"
    bare = f"regexp_replace({bare}, '[.!?,]+$', '')"
    return _squeeze(f"regexp_replace({bare}, '^(the |a |an )', '')")


def _f1(p: str, g: str) -> str:
    """Token F1 of two word lists given as column names."""
    same = (
        f"list_sum(list_transform(list_distinct(list_intersect({p}, {g})), lambda w: "
        f"least(len(list_filter({p}, lambda x: x = w)), len(list_filter({g}, lambda x: x = w)))))"
    )
    same = f"coalesce({same}, 0)::DOUBLE"
    return (
        f"CASE WHEN len({p}) = 0 AND len({g}) = 0 THEN 1.0::DOUBLE "
        f"WHEN len({p}) = 0 OR len({g}) = 0 OR {same} = 0 THEN 0.0::DOUBLE "
        f"ELSE 2 * ({same} / len({p})) * ({same} / len({g})) "
        f"/ (({same} / len({p})) + ({same} / len({g}))) END"
    )


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# Shared parts ---------------------------------------------------------------


def _chunks(size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> str:
    step = max(1, size - overlap)
    return f"""pages AS (
  SELECT doc_id, coalesce(nullif(source, ''), '{NO_TITLE}') AS title, {_tokens('text')} AS toks
  FROM documents),
starts AS (
  SELECT doc_id, title, toks, unnest(range(0, len(toks), {step})) AS st FROM pages),
chunks AS (
  SELECT doc_id, (st // {step})::INTEGER AS chunk_pos,
         title || ': ' || array_to_string(toks[st + 1 : st + {size}], ' ') AS passage
  FROM starts)"""


_DEDUP = """kept AS (
  SELECT passage, min(struct_pack(d := doc_id, c := chunk_pos)) AS o, count(*) AS copies
  FROM chunks GROUP BY passage)"""

_PASSAGES = """passages AS (
  SELECT (row_number() OVER (ORDER BY o.d, o.c) - 1)::BIGINT AS passage_id, passage FROM kept)"""

_CORPUS = (_chunks(), _DEDUP, _PASSAGES)


def _vectors(name: str, source: str, key: str, text: str) -> str:
    return f"""{name}_raw AS (
  SELECT {key} AS id, unnest({_words(text)}) AS w FROM {source}),
{name}_sum AS (
  SELECT id, (('0x' || substr(md5(w), 1, 8))::UBIGINT % 256)::INTEGER AS bucket,
         sum(CASE WHEN substr(md5(w), 9, 1) >= '8' THEN -1 ELSE 1 END)::DOUBLE AS v
  FROM {name}_raw GROUP BY ALL),
{name} AS (
  SELECT id, bucket, (v / sqrt(sum(v * v) OVER (PARTITION BY id)))::FLOAT AS v
  FROM {name}_sum WHERE v <> 0)"""


_PASSAGE_VECTORS = _vectors("pv", "passages", "passage_id", "passage")
_QUESTIONS = f"""questions AS (
  SELECT item_id AS qid, text AS question,
         list_transform({_pieces('text', '[.!?\\n]+')}, lambda s: lower(s)) AS aliases,
         coalesce({_pieces('text', '[.!?\\n]+')}[-1], '') AS gold
  FROM benchmark)"""
_QUESTION_VECTORS = _vectors("qv", "questions", "qid", "question")


def _hits(n: int) -> str:
    return f"""dots AS (
  SELECT qv.id AS qid, pv.id AS passage_id, sum(qv.v::DOUBLE * pv.v::DOUBLE) AS dot
  FROM qv JOIN pv USING (bucket) GROUP BY ALL),
scored AS (
  SELECT q.qid, p.passage_id, coalesce(d.dot, 0) AS dot
  FROM questions q CROSS JOIN passages p LEFT JOIN dots d USING (qid, passage_id)),
hits AS (
  -- Sums in another order differ in the last digits where exact scores are equal.
  SELECT qid, passage_id, round(dot, 7) AS score,
         row_number() OVER (PARTITION BY qid ORDER BY round(dot, 13) DESC, passage_id)::INTEGER AS candidate_rank
  FROM scored QUALIFY candidate_rank <= {n})"""


_WEIGHTS = f"""question_words AS (
  SELECT DISTINCT qid, unnest({_words('question')}) AS w FROM questions),
frequency AS (
  SELECT w, count(*) AS df FROM (
    SELECT DISTINCT passage_id, unnest({_words('passage')}) AS w FROM passages) GROUP BY w),
weights AS (
  SELECT qid, w, round(ln(1 + (SELECT count(*) FROM passages)::DOUBLE / df) * 1000000)::BIGINT AS weight
  FROM question_words JOIN frequency USING (w)),
candidate_words AS (
  SELECT DISTINCT passage_id, unnest({_words('passage')}) AS w
  FROM passages WHERE passage_id IN (SELECT passage_id FROM hits)),
matched AS (
  SELECT h.qid, h.passage_id, sum(weight)::DOUBLE / 1000000 AS total
  FROM hits h JOIN weights USING (qid) JOIN candidate_words c
    ON c.passage_id = h.passage_id AND c.w = weights.w
  GROUP BY ALL),
ranked AS (
  SELECT h.qid, h.passage_id, h.score, h.candidate_rank, p.passage, coalesce(o.total, 0) AS rerank_score,
         row_number() OVER (PARTITION BY h.qid ORDER BY coalesce(o.total, 0) DESC, candidate_rank)::INTEGER AS rank
  FROM hits h LEFT JOIN matched o USING (qid, passage_id) JOIN passages p USING (passage_id))"""

_SEARCHED = (*_CORPUS, _PASSAGE_VECTORS, _QUESTIONS, _QUESTION_VECTORS)
_RERANKED = (*_SEARCHED, _hits(100), _WEIGHTS)


def _recall(ranked: str, by: str = "", questions: str = "questions") -> str:
    """Recall per k of (qid, rank, passage) rows; `by` are question columns."""
    lead = f"{by}, " if by else ""
    return f"""
SELECT {lead}k, round(avg(CASE WHEN first_hit <= k THEN 1 ELSE 0 END), 6) AS recall, count(*) AS questions
FROM (
  SELECT q.*, (SELECT min(r.rank) FROM {ranked} r WHERE r.qid = q.qid
    AND len(list_filter(q.aliases, lambda a: contains(lower(r.passage), a))) > 0) AS first_hit
  FROM {questions} q) CROSS JOIN (SELECT unnest([1, 3, 5, 10])::INTEGER AS k)
GROUP BY {lead}k"""


def _asked(k: int) -> str:
    return f"""asked AS (
  SELECT q.*, coalesce(l.passages, []) AS passages FROM questions q LEFT JOIN (
    SELECT qid, list(passage ORDER BY rank) AS passages FROM ranked WHERE rank <= {k} GROUP BY qid
  ) l USING (qid))"""


_CONTEXT = (
    "array_to_string(list_transform(passages, lambda p, i: "
    "'Passage ' || i || ':\n' || p), '\n\n')"
)
_USER = f"'Question: ' || question || '\n\nPassages:\n' || {_CONTEXT} || '\n\n' || {_text(CLOSING)}"


def _sentences(k: int, samples: int) -> tuple[str, ...]:
    return (
        _asked(k),
        f"""split AS (
  SELECT qid, question, flatten(list_transform(passages, lambda p: {_pieces('p', '[.!?]+')})) AS sents
  FROM asked),
listed AS (
  SELECT qid, question, unnest(sents) AS sentence, generate_subscripts(sents, 1) AS place FROM split),
ordered AS (
  SELECT qid, sentence, row_number() OVER (PARTITION BY qid ORDER BY
    len(list_distinct(list_intersect({_words('question')}, {_words('sentence')}))) DESC, place) - 1 AS sample_idx
  FROM listed),
samples AS (
  SELECT q.qid, s.sample_idx::INTEGER AS sample_idx, coalesce(o.sentence, '') AS answer
  FROM questions q CROSS JOIN (SELECT unnest(range({samples})) AS sample_idx) s
  LEFT JOIN ordered o USING (qid, sample_idx))""",
    )


def _vote(contexts: str) -> str:
    """`voted` from samples(qid, sample_idx, answer) and a table with passages."""
    return f"""counted AS (
  SELECT qid, norm, count(*) AS votes, min(sample_idx) AS first_idx, arg_min(answer, sample_idx) AS raw
  FROM (SELECT *, {_vote_key('answer')} AS norm FROM samples) GROUP BY qid, norm),
checked AS (
  SELECT c.*, norm <> '' AND len(list_filter(a.passages,
    lambda p: contains({_squeeze('lower(p)')}, norm))) > 0 AS in_ctx
  FROM counted c JOIN {contexts} a USING (qid)),
winners AS (
  SELECT qid, raw, votes FROM checked WHERE in_ctx
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY votes DESC, first_idx) = 1),
voted AS (
  SELECT s.qid, coalesce(w.raw, s.answer) AS answer, coalesce(w.votes, 0)::BIGINT AS votes,
         w.qid IS NOT NULL AS in_context
  FROM (SELECT * FROM samples WHERE sample_idx = 0) s LEFT JOIN winners w USING (qid))"""


def _log(answers: str, k: int = 3) -> str:
    """`log` of one answer per question."""
    return f"""logged AS (
  SELECT a.question, a.gold, list_append(a.aliases, a.gold) AS golds, s.answer AS predicted,
         {_answer_words('s.answer')} AS pw, {_normal('s.answer')} AS pn, a.passages
  FROM asked a JOIN {answers} s USING (qid)),
log AS (
  SELECT question, gold, golds, predicted, passages,
    CASE WHEN len(list_filter(golds, lambda g: {_normal('g')} = pn)) > 0 THEN 1 ELSE 0 END::INTEGER AS exact_match,
    list_max(list_transform(list_transform(golds, lambda g: {_answer_words('g')}), lambda gw: {_f1('pw', 'gw')})) AS f1
  FROM logged)"""


_PAIRS = f"""pairs AS (
  SELECT u.conv_id, u.turn, u.text AS predicted, a.text AS gold, {_pieces('a.text', '[.!?\\n]+')} AS aliases,
         {_answer_words('u.text')} AS pw, {_answer_words('a.text')} AS gw
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

_VOTE_INPUT = f"""turns AS (
  SELECT conv_id * 1000000 + turn AS qid, {_tokens('gold')} AS toks, [predicted] AS passages FROM pairs),
samples AS (
  SELECT qid, (generate_subscripts(toks, 1) - 1)::INTEGER AS sample_idx, unnest(toks) AS answer FROM turns)"""


def _split(validation: int, rows: int, source: str = "documents") -> str:
    return f"""numbered AS (
  SELECT doc_id AS ord, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM {source}),
labelled AS (
  SELECT ord, CASE WHEN n < {validation} THEN 'validation' ELSE 'train' END AS split,
         CASE WHEN n < {validation} THEN n ELSE n - {validation} END AS pos FROM numbered),
everything AS (
  SELECT * FROM labelled UNION ALL
  SELECT doc_id, 'test', row_number() OVER (ORDER BY doc_id) - 1 FROM labels),
sharded AS (
  SELECT split, (pos // {rows})::INTEGER AS shard, pos::BIGINT AS pos, ord FROM everything)"""


_SHARDED = _split(300, 50)
_EXAMPLES = _split(300, 50).replace("FROM labels", "FROM documents")


def _head(condition: str, rows: int | None = 100) -> str:
    """`questions` from the first examples per split, or from all."""
    first = f"QUALIFY row_number() OVER (PARTITION BY split ORDER BY 'shard_' || shard, pos) <= {rows}" if rows else ""
    return f"""questions AS (
  SELECT row_number() OVER (ORDER BY s.split, s.pos) AS qid, s.split, d.text AS question,
         list_transform(string_split(d.text, chr(10)), lambda l: {_normal('l')}) AS aliases,
         concat_ws(' ', d.lang, d.source) AS gold
  FROM (SELECT * FROM sharded WHERE {condition}
        {first}) s
  JOIN documents d ON d.doc_id = s.ord)"""


def _shard_pages(
    condition: str, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP
) -> tuple[str, ...]:
    """`chunks`, `kept` and `passages` of the pages inside the chosen shards."""
    step = size - overlap
    return (
        _EXAMPLES,
        f"""ordered AS (
  SELECT ord, row_number() OVER (ORDER BY
    CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END, 'shard_' || shard, pos) AS place
  FROM sharded WHERE {condition}),
lined AS (
  SELECT o.place, d.source, string_split(d.text, chr(10)) AS lines
  FROM ordered o JOIN documents d ON d.doc_id = o.ord),
paged AS (
  SELECT place, i, coalesce(nullif(CASE WHEN i = 1 THEN source ELSE lines[i - 1] END, ''), '{NO_TITLE}') AS title,
         {_tokens('lines[i]')} AS toks
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM lined)),
started AS (SELECT *, unnest(range(0, len(toks), {step})) AS st FROM paged),
chunks AS (
  SELECT place * 1000000 + i AS doc_id, st AS chunk_pos,
         title || ': ' || array_to_string(toks[st + 1 : st + {size}], ' ') AS passage FROM started)""",
        _DEDUP,
        _PASSAGES,
    )


_TWO_SHARDS = """split <> 'test' AND (split, shard) IN (
    SELECT (split, shard) FROM (SELECT DISTINCT split, shard FROM sharded)
    QUALIFY row_number() OVER (PARTITION BY split ORDER BY 'shard_' || shard) <= 2)"""


_LINES = r"string_split(text, chr(10))"

_COLUMNS = (
    ("ord", "bigint"),
    ("question", "string"),
    (
        "answer",
        "struct<value:string,normalized_value:string,aliases:array<string>,normalized_aliases:array<string>>",
    ),
    ("entity_pages", "struct<title:array<string>,wiki_context:array<string>>"),
)


def _clip(text: str, limit: int = PREVIEW_CHARS) -> str:
    return f"CASE WHEN length({text}) > {limit} THEN left({text}, {limit}) || '...' ELSE {text} END"


def _word_count(text: str) -> str:
    return f"len({_kept(f'string_split_regex({text}, {_text(_UNICODE_BLANKS)})')})::INTEGER"


def _top(items: str) -> str:
    """Most common of (item, place) rows."""
    return f"""
SELECT item, count(*) AS n FROM ({items}) GROUP BY item ORDER BY n DESC, min(place) LIMIT 10"""


def _sweep() -> str:
    parts = []
    for run, (size, overlap) in enumerate(SWEEP, 1):
        parts.append(f"""SELECT {run}::INTEGER AS run, {size}::INTEGER AS chunk_tokens, {overlap}::INTEGER AS chunk_overlap,
    passage_id, passage FROM ({_with(_chunks(size, overlap), _DEDUP, _PASSAGES)} SELECT * FROM passages)""")
    return " UNION ALL ".join(parts)


def _from_documents(size: int, overlap: int) -> tuple[str, ...]:
    return _chunks(size, overlap), _DEDUP, _PASSAGES


def _from_shards(size: int, overlap: int) -> tuple[str, ...]:
    return _shard_pages("true", size, overlap)


def _sweep_recall(source=_from_documents) -> str:
    parts = []
    for run, (size, overlap) in enumerate(SWEEP, 1):
        chunked = source(size, overlap)
        body = _with(
            *chunked, _PASSAGE_VECTORS, _QUESTIONS, _QUESTION_VECTORS, _hits(100), _WEIGHTS,
        ) + _recall("ranked")
        parts.append(f"""SELECT {run}::INTEGER AS run, {size}::INTEGER AS chunk_tokens, {overlap}::INTEGER AS chunk_overlap,
    (SELECT count(*) FROM ({_with(*chunked)} SELECT DISTINCT passage FROM chunks)) AS passages,
    k, recall, questions FROM ({body})""")
    return " UNION ALL ".join(parts)



def _nearest(asked: str = "embedding", indexed: str = "embedding", digits: int = 7) -> str:
    return f"""
WITH a AS (SELECT vec_id, ({asked})::DOUBLE[] AS v FROM embeddings),
b AS (SELECT vec_id, ({indexed})::DOUBLE[] AS v FROM embeddings)
SELECT qid, passage_id, round(dot, {digits}) AS score, rank FROM (
  SELECT a.vec_id AS qid, b.vec_id AS passage_id, list_dot_product(a.v, b.v) AS dot,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY list_dot_product(a.v, b.v) DESC, b.vec_id)::INTEGER AS rank
  FROM a CROSS JOIN b) WHERE rank <= 10"""


_LETTER_COUNTS = [f"length(passage) - length(replace(passage, '{x}', ''))" for x in "etnaoi "]


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{_UNICODE_BLANKS}|{_UNICODE_BLANKS}$', '', 'g')"


_COMPONENTS = "SELECT id AS passage_id, bucket, round(v::DOUBLE, 6) AS value FROM pv"
_PAYLOAD = """SELECT s.split, s.shard, s.pos, s.ord, d.lang, d.source, d.text
FROM ({}) s JOIN documents d ON d.doc_id = s.ord"""
_RETITLED = _chunks().replace(f"coalesce(nullif(source, ''), '{NO_TITLE}')", "'renamed'")

ORACLES = {
    "unnest_pages": f"""
SELECT doc_id AS example_ord, (i - 1)::INTEGER AS page_pos,
       coalesce(nullif(CASE WHEN i = 1 THEN source ELSE lines[i - 1] END, ''), '{NO_TITLE}') AS title,
       lines[i] AS text
FROM (SELECT doc_id, source, lines, unnest(range(1, len(lines) + 1)) AS i
      FROM (SELECT doc_id, source, {_LINES} AS lines FROM documents))""",
    "chunk_passages": _with(_chunks()) + "SELECT doc_id, chunk_pos, passage FROM chunks",
    "dedup_passages": _with(_chunks(), _DEDUP)
    + "SELECT o.d AS doc_id, o.c AS chunk_pos, copies, passage FROM kept",
    "passage_ids": _with(*_CORPUS) + "SELECT passage_id, passage FROM passages",
    "hash_embed": _with(*_CORPUS, _PASSAGE_VECTORS)
    + "SELECT id AS passage_id, bucket, round(v::DOUBLE, 6) AS value FROM pv",
    "l2_normalize": """
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: (x * label)::FLOAT) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x::DOUBLE * x::DOUBLE))) AS norm FROM s),
u AS (SELECT vec_id, list_transform(v, lambda x: (x::DOUBLE / CASE WHEN norm = 0 THEN 1e-10 ELSE norm END)::FLOAT) AS v FROM n)
SELECT vec_id, (generate_subscripts(v, 1) - 1)::INTEGER AS pos, round(unnest(v)::DOUBLE, 6) AS value FROM u""",
    "index_reuse": _with(*_CORPUS, _PASSAGE_VECTORS) + _COMPONENTS,
    "index_two_encoders": _with(_RETITLED, _DEDUP, _PASSAGES, _PASSAGE_VECTORS) + _COMPONENTS,
    "index_two_tokenizers": _with(*_CORPUS) + "SELECT passage_id, passage FROM passages",
    "model_encoder": _with(
        *_CORPUS, f"counted AS (SELECT passage_id, [{', '.join(_LETTER_COUNTS)}]::DOUBLE[] AS c FROM passages)"
    )
    + """SELECT passage_id, (i - 1)::INTEGER AS pos,
  round((c[i] / CASE WHEN norm = 0 THEN 1e-10 ELSE norm END)::FLOAT::DOUBLE, 6) AS value
FROM (SELECT *, sqrt(list_dot_product(c, c)) AS norm, unnest(range(1, 8)) AS i FROM counted)""",
    "model_tokens": f"""
SELECT doc_id, (st // 180)::INTEGER AS chunk_pos, source || ': ' || {_strip('substr(text, st + 1, 240)')} AS passage
FROM (SELECT *, unnest(range(0, length(text), 180)) AS st FROM documents)""",
    "model_scorer": _with(*_SEARCHED, _hits(100))
    + """SELECT qid, candidate_rank, rank, rerank_score FROM (
  SELECT h.qid, candidate_rank, least(400, length(passage) - length(question))::DOUBLE AS rerank_score,
    row_number() OVER (PARTITION BY h.qid ORDER BY least(400, length(passage) - length(question)) DESC, candidate_rank)::INTEGER AS rank
  FROM hits h JOIN passages USING (passage_id) JOIN questions q ON q.qid = h.qid)""",
    "model_answers_text": _with(
        *_RERANKED, _asked(5), f"whole AS (SELECT qid, {_text(instruction(True))} || '\n\n' || {_USER} AS p FROM asked)",
        f"cut AS (SELECT qid, CASE WHEN length(p) <= 2048 THEN p ELSE {_strip('left(p, 2048)')} END AS p FROM whole)",
    )
    + """SELECT qid, i::INTEGER AS sample_idx, i > 0 AS do_sample,
  length(p) || ':' || right(p, 12) || ':' || CASE WHEN i > 0 THEN 1 ELSE 0 END AS answer
FROM cut CROSS JOIN (SELECT unnest([0, 1]) AS i)""",
    "model_answers_chat": _with(*_RERANKED, _asked(5))
    + f"""SELECT qid, 0::INTEGER AS sample_idx, false AS do_sample,
  'system=' || length({_text(instruction(False))}) || ' user=' || length({_USER}) AS answer FROM asked""",
    "topk_inner_product": _nearest(),
    "topk_blocks": _nearest(),
    "topk_scaled": _nearest(
        "list_transform(embedding, lambda x: (x::DOUBLE * 0.001)::FLOAT)",
        "list_transform(embedding, lambda y: (y::DOUBLE * label)::FLOAT)", 9,
    ),
    "topk_underfull": """
WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
m AS (SELECT label, pos, avg(x)::FLOAT AS x FROM x GROUP BY ALL),
c AS (SELECT label::BIGINT AS passage_id, list(x ORDER BY pos) AS v FROM m GROUP BY label),
s AS (SELECT vec_id AS qid, passage_id, list_dot_product(embedding::DOUBLE[], v::DOUBLE[]) AS dot
      FROM embeddings CROSS JOIN c)
SELECT qid, passage_id, round(dot, 7) AS score,
       row_number() OVER (PARTITION BY qid ORDER BY dot DESC, passage_id)::INTEGER AS rank FROM s""",
    "retrieve": _with(*_RERANKED)
    + """SELECT qid, rank, candidate_rank, passage_id, score, rerank_score FROM ranked WHERE rank <= 3""",
    "retrieve_vector_only": _with(*_SEARCHED, _hits(100))
    + """SELECT qid, candidate_rank AS rank, passage_id, score, passage
FROM hits JOIN passages USING (passage_id) WHERE candidate_rank <= 10""",
    "rerank_overlap": _with(*_SEARCHED, _hits(50), _WEIGHTS)
    + "SELECT qid, candidate_rank, rank, rerank_score FROM ranked",
    "recall_at_k": _with(*_RERANKED) + _recall("ranked"),
    "recall_by_split": _with(
        *_RERANKED,
        """parts AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY qid) <= 15
  THEN 'validation' ELSE 'train' END AS split FROM questions)""",
    )
    + _recall("ranked", "split", "parts"),
    "recall_with_without_rerank": _with(
        *_RERANKED, "plain AS (SELECT qid, candidate_rank AS rank, passage FROM ranked)"
    )
    + f"SELECT 'rerank' AS variant, * FROM ({_recall('ranked')}) UNION ALL "
    f"SELECT 'vector' AS variant, * FROM ({_recall('plain')})",
    "chunk_sweep": _sweep_recall(),
    "sweep_passages": _sweep(),
    "normalize_answer": f"SELECT doc_id, {_normal('text')} AS normalized FROM documents",
    "normalize_vote": f"""
SELECT doc_id, (i - 1)::INTEGER AS line, {_vote_key('lines[i]')} AS norm
FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
      FROM (SELECT doc_id, {_LINES} AS lines FROM documents))""",
    "exact_match": _with(_PAIRS)
    + f"""SELECT conv_id, turn, (pw = gw)::INTEGER AS same,
  (gw = {_answer_words("'The ' || gold || '?!'")})::INTEGER AS variant FROM pairs""",
    "token_f1": _with(_PAIRS)
    + f"SELECT conv_id, turn, round({_f1('pw', 'gw')}, 6) AS f1 FROM pairs",
    "best_of_aliases": _with(
        _PAIRS,
        "asked AS (SELECT *, list_append(aliases, gold) AS golds FROM pairs)",
    )
    + f"""SELECT conv_id, turn,
  CASE WHEN len(list_filter(golds, lambda g: {_answer_words('g')} = pw)) > 0 THEN 1 ELSE 0 END::INTEGER AS exact_match,
  round(list_max(list_transform(list_transform(golds, lambda g: {_answer_words('g')}), lambda gw2: {_f1('pw', 'gw2')})), 6) AS f1
FROM asked""",
    "eval_log": _with(
        *_RERANKED, *_sentences(3, 1), _log("samples")
    )
    + f"""SELECT question, gold, predicted, exact_match, round(f1, 6) AS f1, to_json(golds)::VARCHAR AS aliases,
  array_to_string(list_transform(passages, lambda p: left(p, {LOG_PREFIX_CHARS})), '|') AS retrieved FROM log""",
    "rag_eval": _with(*_RERANKED, *_sentences(3, 1), _log("samples"))
    + "SELECT round(avg(exact_match), 6) AS exact_match, round(avg(f1), 6) AS f1, count(*) AS questions FROM log",
    "rag_eval_consensus": _with(*_RERANKED, *_sentences(3, 3), _vote("asked"), _log("voted"))
    + "SELECT round(avg(exact_match), 6) AS exact_match, round(avg(f1), 6) AS f1, count(*) AS questions FROM log",
    "context_block": _with(*_RERANKED, _asked(5)) + f"SELECT qid, {_CONTEXT} AS context FROM asked",
    "prompt_text": _with(
        *_RERANKED,
        _asked(12),
        f"""whole AS (SELECT qid, {_text(instruction(False))} || '\n\n' || {_USER} AS one,
  {_text(instruction(True))} || '\n\n' || {_USER} AS many FROM asked)""",
    )
    + rf"""SELECT qid,
  array_to_string(regexp_extract_all(one, '\s*\S+')[1:{MAX_PROMPT_TOKENS}], '') AS prompt,
  array_to_string(regexp_extract_all(many, '\s*\S+')[1:{MAX_PROMPT_TOKENS}], '') AS vote_prompt FROM whole""",
    "chat_messages": _with(*_RERANKED, _asked(5))
    + f"""SELECT qid, 0::INTEGER AS pos, 'system' AS role, {_text(instruction(False))} AS content FROM asked
UNION ALL SELECT qid, 1::INTEGER, 'user', {_USER} FROM asked""",
    "generate_extractive": _with(*_RERANKED, *_sentences(5, 3))
    + "SELECT qid, sample_idx, sample_idx > 0 AS do_sample, answer FROM samples",
    "answer_consensus": _with(*_RERANKED, *_sentences(5, 5), _vote("asked"))
    + "SELECT qid, answer FROM voted",
    "vote_consensus": _with(_PAIRS, _VOTE_INPUT, _vote("turns")) + "SELECT * FROM voted",
    "answer_in_context": _with(_PAIRS, _VOTE_INPUT)
    + f"""SELECT s.qid, sample_idx, norm <> '' AND len(list_filter(t.passages,
    lambda p: contains({_squeeze('lower(p)')}, norm))) > 0 AS in_context
FROM (SELECT *, {_vote_key('answer')} AS norm FROM samples) s JOIN turns t USING (qid)""",
    "split_shards": _with(_SHARDED) + _PAYLOAD.format("SELECT * FROM sharded"),
    "shards_resume": _with(_SHARDED) + _PAYLOAD.format("SELECT * FROM sharded"),
    "source_order": _with(_SHARDED)
    + """SELECT split, shard, pos, row_number() OVER (ORDER BY
  CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END, 'shard_' || shard, pos) - 1 AS place FROM sharded""",
    "head_sample": _with(_split(100, 20))
    + _PAYLOAD.format("""SELECT * FROM sharded WHERE split = 'train'
ORDER BY 'shard_' || shard, pos LIMIT 100"""),
    "head_per_split": _with(_SHARDED)
    + _PAYLOAD.format("""SELECT * FROM sharded
QUALIFY row_number() OVER (PARTITION BY split ORDER BY 'shard_' || shard, pos) <= 100"""),
    "shard_limit": _with(_SHARDED)
    + _PAYLOAD.format("""SELECT * FROM sharded
QUALIFY dense_rank() OVER (PARTITION BY split ORDER BY 'shard_' || shard) <= 2"""),
    "index_from_shards": _with(*_shard_pages(_TWO_SHARDS), _PASSAGE_VECTORS) + _COMPONENTS,
    "sweep_from_shards": _sweep_recall(_from_shards),
    "read_examples": f"""
SELECT doc_id AS ord, text AS question, source AS value, len({_LINES})::INTEGER AS aliases,
  len({_LINES})::INTEGER + 1 AS titles, (SELECT count(*) FROM documents WHERE doc_id % 7 = 0) AS damaged_lines
FROM documents WHERE doc_id % 7 <> 0""",
    "passages_from_shards": _with(*_shard_pages("true")) + "SELECT passage_id, passage FROM passages",
    "recall_from_shards": _with(
        *_CORPUS, _PASSAGE_VECTORS, _EXAMPLES, _head("true", None), _QUESTION_VECTORS, _hits(100), _WEIGHTS
    )
    + _recall("ranked", "split"),
    "answers_from_shards": _with(
        *_CORPUS, _PASSAGE_VECTORS, _EXAMPLES, _head("split = 'test'"), _QUESTION_VECTORS, _hits(100),
        _WEIGHTS, *_sentences(3, 1), _log("samples"),
    )
    + "SELECT round(avg(exact_match), 6) AS exact_match, round(avg(f1), 6) AS f1, count(*) AS questions FROM log",
    "describe_columns": " UNION ALL ".join(
        f"SELECT count(*) AS n_rows, {i}::INTEGER AS position, '{name}' AS \"column\", '{kind}' AS type FROM documents"
        for i, (name, kind) in enumerate(_COLUMNS)
    ),
    "word_stats": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg({_word_count(c)}), 6) AS mean_words,
  min({_word_count(c)}) AS min_words, max({_word_count(c)}) AS max_words FROM documents"""
        for c in ("text", "lang", "source")
    ),
    "top_labels": _top("SELECT concat_ws(' ', lang, source) AS item, doc_id AS place FROM documents"),
    "top_quality": _top("SELECT quality::VARCHAR AS item, doc_id AS place FROM labels"),
    "common_answers": _top(
        f"""SELECT unnest(l) AS item, doc_id * 1000000 + generate_subscripts(l, 1) AS place
  FROM (SELECT doc_id, {_LINES} AS l FROM documents)"""
    ),
    "mean_length": f"""SELECT round(avg({_word_count('source')}), 6) AS mean_words FROM documents
UNION ALL SELECT round(avg({_word_count('text')}), 6) FROM documents""",
    "length_histogram": f"""
WITH l AS (SELECT {_word_count('text')} AS n FROM documents),
r AS (SELECT CASE WHEN min(n) = max(n) THEN min(n) - 0.5 ELSE min(n) END::DOUBLE AS lo,
             CASE WHEN min(n) = max(n) THEN max(n) + 0.5 ELSE max(n) END::DOUBLE AS hi FROM l),
e AS (SELECT b::INTEGER AS bin, lo + b * ((hi - lo) / 30) AS low,
             CASE WHEN b = 29 THEN hi ELSE lo + (b + 1) * ((hi - lo) / 30) END AS high
      FROM r CROSS JOIN (SELECT unnest(range(30)) AS b))
SELECT bin, round(low, 6) AS low, round(high, 6) AS high,
       (SELECT count(*) FROM l WHERE n >= low AND (n < high OR bin = 29))::BIGINT AS n_rows FROM e""",
    "sample_qa": f"""
SELECT doc_id AS ord, text AS question, array_to_string({_LINES}[1:3], ', ') AS answers
FROM documents ORDER BY doc_id LIMIT 20""",
    "truncate_nested": f"""
SELECT doc_id AS ord, {_clip('text')} AS question, {_clip('source')} AS value,
  array_to_string(list_transform({_LINES}, lambda s: {_clip('s')}), '|') AS aliases,
  array_to_string(list_transform(list_prepend(source, {_LINES}), lambda s: {_clip('s')}), '|') AS titles
FROM documents""",
    "sample_rows": f"""
SELECT doc_id, {_clip('text')} AS text, {_clip('lang')} AS lang, {_clip('source')} AS source, n_chars
FROM documents ORDER BY doc_id LIMIT 3""",
    "preview_passages": f"""
SELECT doc_id, replace(left(text, {LOG_PREFIX_CHARS}), chr(10), ' ') AS preview FROM documents""",
    "stream_ingest_dedup": _with(_chunks()) + "SELECT DISTINCT passage FROM chunks",
    "stream_shards": """
SELECT doc_id, pos, (pos // 50)::INTEGER AS shard, lang, source, text
FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)""",
}
