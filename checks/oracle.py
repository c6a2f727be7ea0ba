"""The queries of the registry as DuckDB SQL, written from the operators' definitions.

``CTES`` holds the common table expressions. A query gets those it names after FROM or JOIN, directly or not.
"""

from __future__ import annotations

import re

from checks.registry import ALPHAS, STEPS, TOP_N
from lexmill.functions.cleaning import ARTICLE_RULES, REVIEW_LITERALS
from lexmill.views import ARTICLE_MARKS, REVIEW_MARK

V = TOP_N + 3


def _quote(text: str) -> str:
    """A SQL string literal; newlines as chr(10)."""
    return " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in text.split("\n"))


def _u(seed: int, key: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _strip_marks(text: str) -> str:
    text = f"trim({text}, chr(10))"
    for literal in REVIEW_LITERALS:
        text = f"replace({text}, {_quote(literal)}, '')"
    return text


def _collapse(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


def _clean(text: str) -> str:
    for rule in ARTICLE_RULES:
        rule = rule.replace(r"\S", r"[^\s\x{1c}-\x{1f}\x{85}\pZ]")
        text = f"regexp_replace({text}, '{rule}', '', 'g')"
    return text


def _words(text: str) -> str:
    return f"string_split({text}, ' ')"


def _units(text: str, unit: str = "word") -> str:
    split = _words(text) if unit == "word" else f"string_split({text}, '')"
    return f"list_filter({split}, lambda w: w <> '' AND w <> ' ')"


def _ints(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


def _r(value: str) -> str:
    return f"round({value}, 6)"


CTES: dict[str, str] = {}

# -- views --------------------------------------------------------------------------------------------

CTES["reviews"] = f"""
    SELECT d.doc_id AS Id, l.quality AS Category, d.text,
           CASE WHEN l.quality IS NULL THEN 'test' WHEN {_u(42, 'd.doc_id')} < 0.8 THEN 'train' ELSE 'dev' END AS split
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
CTES["marked"] = f"SELECT Id, Category, CASE WHEN Id % 2 = 0 THEN text || {_quote(REVIEW_MARK)} ELSE text END AS text, split FROM reviews"
CTES["articles"] = """
    SELECT doc_id::VARCHAR AS id, substr(text, instr(text, chr(10)) + 1) AS maintext, substr(text, 1, instr(text, chr(10)) - 1) AS title
    FROM documents WHERE instr(text, chr(10)) > 1"""
CTES["news"] = (
    "SELECT id, title, maintext || CASE id::BIGINT % 18 "
    + " ".join(f"WHEN {i} THEN {_quote(m)}" for i, m in enumerate(ARTICLE_MARKS))
    + " END AS maintext FROM articles"
)
CTES["clean_news"] = f"SELECT id, title, {_clean('maintext')} AS maintext FROM news"
CTES["clean_articles"] = f"SELECT id, title, {_clean('maintext')} AS maintext FROM articles"
CTES["dialog"] = """
    SELECT a.conv_id || '-' || a.turn AS id, a.text AS pred, b.text AS ref
    FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
    WHERE a.role = 'user' AND b.role = 'assistant'"""
CTES["first_sentences"] = """
    SELECT id, title AS ref, trim(regexp_extract(trim(maintext), '^[^.!?。！？]*')) AS lead FROM articles"""
CTES["lead"] = "SELECT id, CASE WHEN length(lead) > 0 THEN lead ELSE '無' END AS pred, ref FROM first_sentences"

# -- vocabularies, bags and scores; the same for plain and for marked reviews --------------------------

for _s, _source in (("", "reviews"), ("_m", "marked")):
    CTES[f"freqs{_s}"] = f"""
        SELECT cls, word, count(*) AS freq FROM (
            SELECT CASE WHEN Category = 0 THEN 'neg' ELSE 'pos' END AS cls, unnest({_words(_collapse(_strip_marks('text')))}) AS word
            FROM {_source} WHERE split = 'train') GROUP BY cls, word"""
    CTES[f"vocab{_s}"] = f"""
        SELECT cls, word, row_number() OVER (PARTITION BY cls ORDER BY freq, word) - 1 AS idx, freq FROM freqs{_s} WHERE freq > 10"""
    CTES[f"bag{_s}"] = f"""
        SELECT Id, cls, idx, count(*) AS cnt FROM (SELECT Id, unnest({_words("coalesce(text, 'nan')")}) AS word FROM {_source}) t
        JOIN vocab{_s} USING (word) GROUP BY Id, cls, idx"""
CTES["alphas"] = "SELECT epoch, alpha FROM (VALUES " + ", ".join(f"({i}, {a}::DOUBLE)" for i, a in enumerate(ALPHAS, 1)) + ") t(epoch, alpha)"
CTES["counts"] = """
    SELECT v.cls, v.idx, coalesce(sum(f.freq) FILTER (f.cls = 'neg'), 0) AS f0, coalesce(sum(f.freq) FILTER (f.cls = 'pos'), 0) AS f1
    FROM vocab v JOIN freqs f ON f.word = v.word GROUP BY v.cls, v.idx"""
CTES["totals"] = "SELECT cls, sum(f0) AS t0, sum(f1) AS t1, count(*) AS v FROM counts GROUP BY cls"
CTES["all_weights"] = """
    SELECT epoch, c.cls, c.idx, ln((f0 + alpha) / (t0 + alpha * v)) AS w0, ln((f1 + alpha) / (t1 + alpha * v)) AS w1
    FROM counts c JOIN totals USING (cls) CROSS JOIN alphas"""
CTES["prior"] = """
    SELECT ln(1 - (n1 + 1) / (n + 2)) AS b0, ln((n1 + 1) / (n + 2)) AS b1 FROM (
        SELECT count(*)::DOUBLE AS n, count(*) FILTER (Category IS DISTINCT FROM 0)::DOUBLE AS n1 FROM reviews WHERE split = 'train')"""
CTES["all_scores"] = """
    SELECT g.epoch, g.Id, g.view, coalesce(s.w0, 0) + b0 AS s0, coalesce(s.w1, 0) + b1 AS s1
    FROM (SELECT epoch, Id, view FROM reviews CROSS JOIN alphas CROSS JOIN (VALUES ('neg'), ('pos')) t(view)) g
    LEFT JOIN (SELECT epoch, Id, cls, sum(cnt * w0) AS w0, sum(cnt * w1) AS w1 FROM bag JOIN all_weights USING (cls, idx) GROUP BY epoch, Id, cls) s
        ON s.epoch = g.epoch AND s.Id = g.Id AND s.cls = g.view CROSS JOIN prior"""
CTES["scores"] = f"SELECT Id, view, s0, s1 FROM all_scores WHERE epoch = {ALPHAS.index(1.0) + 1}"
CTES["fused"] = "SELECT Id, avg(s0) AS s0, avg(s1) AS s1 FROM scores GROUP BY Id"
CTES["pred"] = "SELECT Id, CASE WHEN s1 > s0 THEN 1 ELSE 0 END AS pred FROM fused"
CTES["losses"] = """
    SELECT s.Id, view, CASE WHEN Category = 0 THEN s1 - s0 ELSE s0 - s1 END AS gap
    FROM scores s JOIN reviews r ON r.Id = s.Id WHERE split = 'train'"""
CTES["batch_losses"] = f"""
    SELECT epoch, view, batch, avg(loss) AS loss, count(*) AS n FROM (
        SELECT epoch, view, greatest(gap, 0) + ln(1 + exp(-abs(gap))) AS loss,
               ((row_number() OVER (PARTITION BY epoch, view ORDER BY {_u(1, "epoch || ':' || view || ':' || Id")}, Id) - 1) // 64) AS batch
        FROM losses, (SELECT unnest([1, 2, 3]) AS epoch)) GROUP BY epoch, view, batch"""

CTES["kept_epochs"] = """
    SELECT epoch, accuracy, best FROM (
        SELECT epoch, accuracy, coalesce(max(accuracy) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS best FROM (
            SELECT epoch, avg((CASE WHEN s1 > s0 THEN 1 ELSE 0 END = Category)::INT) AS accuracy
            FROM (SELECT epoch, Id, avg(s0) AS s0, avg(s1) AS s1 FROM all_scores GROUP BY epoch, Id) JOIN reviews USING (Id)
            WHERE split = 'dev' GROUP BY epoch)) WHERE accuracy > best"""

# -- encoded features ---------------------------------------------------------------------------------

CTES["news_words"] = f"""
    SELECT word, n AS freq, row_number() OVER (ORDER BY n DESC, word) + 2 AS id FROM (
        SELECT word, count(*) AS n FROM (SELECT unnest({_words("title || ' ' || maintext")}) AS word FROM clean_news) GROUP BY word)"""
CTES["specials"] = "SELECT word, id, 0 AS freq FROM (VALUES ('<pad>', 0), ('</s>', 1), ('<unk>', 2)) t(word, id)"
CTES["news_vocab"] = f"SELECT word, id::INT AS id, freq FROM news_words WHERE id <= {TOP_N} + 2"


def _encoded(source: str, vocab: str, text: str, length: int, key: str = "id") -> str:
    """(key, ids): padded ids of the words of ``text``."""
    return f"""
    SELECT {key}, list_slice(list_concat(list(coalesce(v.id, 2) ORDER BY pos), [1::INT], list_resize([]::INT[], {length}, 0)), 1, {length}) AS ids
    FROM (SELECT {key}, unnest(w) AS word, generate_subscripts(w, 1) AS pos
          FROM (SELECT {key}, list_slice({_words(text)}, 1, {length - 1}) AS w FROM {source})) t
    LEFT JOIN (SELECT word, id::INT AS id FROM {vocab}) v ON v.word = t.word GROUP BY t.{key}""".replace(f"SELECT {key}, list_slice(list_c", f"SELECT t.{key}, list_slice(list_c")


def _started(ids: str, length: int) -> str:
    return f"CASE WHEN {ids}[1] = 259 THEN [0] || {ids}[2:{length}] ELSE [0] || {ids}[1:{length - 1}] END"


def _mask(ids: str) -> str:
    return f"list_transform({ids}, lambda i: CASE WHEN i <> 0 THEN 1 ELSE 0 END)"


def _labels(y: str, length: int) -> str:
    return f"list_transform({y}[2:{length}], lambda i: CASE WHEN i = 0 THEN -100 ELSE i END)"


CTES["text_ids"] = _encoded("clean_news", "news_vocab", "maintext", 512)
CTES["text_ids_128"] = _encoded("clean_news", "news_vocab", "maintext", 128)
CTES["title_ids"] = _encoded("clean_news", "news_vocab", "title", 64)
CTES["forced"] = f"SELECT id, ids, {_started('ids', 64)} AS y FROM title_ids"

# -- next-word table and candidates -------------------------------------------------------------------

CTES["title_vocab"] = f"""
    SELECT word, id::INT AS id FROM (
        SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) + 2 AS id
        FROM (SELECT unnest({_words('title')}) AS word FROM articles) GROUP BY word) WHERE id <= {TOP_N} + 2"""
CTES["bigrams"] = f"""
    SELECT prev, next, cnt, sum(cnt) OVER (PARTITION BY prev)::BIGINT AS prev_cnt,
           ln(cnt::DOUBLE / sum(cnt) OVER (PARTITION BY prev)::DOUBLE) AS logp
    FROM (
        SELECT CASE WHEN p.prev IS NULL THEN 0 ELSE a.id END AS prev, CASE WHEN p.next IS NULL THEN 1 ELSE b.id END AS next, count(*) AS cnt
        FROM (SELECT unnest([NULL] || w) AS prev, unnest(w || [NULL]) AS next FROM (SELECT {_words('title')} AS w FROM articles)) p
        LEFT JOIN title_vocab a ON a.word = p.prev LEFT JOIN title_vocab b ON b.word = p.next
        WHERE (p.prev IS NULL OR a.id IS NOT NULL) AND (p.next IS NULL OR b.id IS NOT NULL) GROUP BY ALL)"""


def _softmax(temperature: float) -> str:
    return f"""
    SELECT prev, next, e / sum(e) OVER (PARTITION BY prev) AS p
    FROM (SELECT prev, next, exp((logp - max(logp) OVER (PARTITION BY prev)) / {temperature}::DOUBLE) AS e FROM bigrams)"""


_MASS = "round(p * 1e12)::BIGINT"
_BY_MASS = f"PARTITION BY prev ORDER BY {_MASS} DESC, next"


def _kept(source: str, rank: str, test: str) -> str:
    return f"""
    SELECT prev, next, p / sum(p) OVER (PARTITION BY prev) AS p
    FROM (SELECT prev, next, p FROM (SELECT *, {rank} AS r FROM {source}) WHERE {test})"""


_BEFORE = f"coalesce(sum({_MASS}) OVER ({_BY_MASS} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
CTES["p_sample"] = _softmax(1.0)
CTES["p_warm"] = _softmax(0.9)
CTES["p_topk"] = _kept("p_warm", f"row_number() OVER ({_BY_MASS})", "r <= 20")
CTES["p_topp"] = _kept("p_warm", _BEFORE, "r <= 600000000000")
CTES["p_synthesis"] = _kept("p_topk", _BEFORE, "r <= 600000000000")
for _mode in ("sample", "topk", "topp", "synthesis"):
    CTES[f"cdf_{_mode}"] = f"""
        SELECT prev, next, hi - m AS lo, CASE WHEN last THEN 1000000000001 ELSE hi END AS hi FROM (
            SELECT prev, next, {_MASS} AS m, sum({_MASS}) OVER ({_BY_MASS} ROWS UNBOUNDED PRECEDING) AS hi,
                   lead(1) OVER ({_BY_MASS}) IS NULL AS last FROM p_{_mode})"""
    CTES[f"walk_{_mode}"] = f"""
        SELECT id, [seed] AS path, seed AS last, 1 AS n FROM seeds
        UNION ALL
        SELECT w.id, list_append(path, c.next), c.next, n + 1 FROM walk_{_mode} w JOIN cdf_{_mode} c
            ON c.prev = w.last AND floor({_u(11, "w.id || ':' || w.n")} * 1e12) >= c.lo AND floor({_u(11, "w.id || ':' || w.n")} * 1e12) < c.hi
        WHERE n < {STEPS}"""
CTES["seeds"] = f"SELECT a.id, coalesce(v.id, 0)::INT AS seed FROM clean_articles a LEFT JOIN title_vocab v ON v.word = {_words('a.maintext')}[1]"
CTES["best"] = "SELECT prev, next FROM (SELECT *, row_number() OVER (PARTITION BY prev ORDER BY cnt DESC, next) AS r FROM bigrams) WHERE r = 1"
CTES["walk_greedy"] = f"""
    SELECT id, [seed] AS path, seed AS last, 1 AS n FROM seeds
    UNION ALL
    SELECT w.id, list_append(path, b.next), b.next, n + 1 FROM walk_greedy w JOIN best b ON b.prev = w.last WHERE n < {STEPS}"""
CTES["options"] = "SELECT prev, list({'next': next, 'step': round(logp * 1e9)::BIGINT}) AS o FROM bigrams GROUP BY prev"


def _beam(name: str, no_repeat: bool) -> str:
    pair = "(list_extract(path, -1)::BIGINT * 4294967296 + {})"
    allowed = "coalesce(o.o, [])"
    if no_repeat:
        allowed = f"list_filter({allowed}, lambda x: NOT list_contains(pairs, {pair.format('x.next')}))"
    return f"""
    SELECT seed, [seed] AS path, 0::BIGINT AS score, []::BIGINT[] AS pairs, 1 AS n FROM (SELECT DISTINCT seed FROM seeds)
    UNION ALL
    SELECT seed, path, score, pairs, n FROM (
        SELECT *, row_number() OVER (PARTITION BY seed ORDER BY score DESC, path) AS r FROM (
            SELECT seed, CASE WHEN c IS NULL THEN path ELSE list_append(path, c.next) END AS path, score + coalesce(c.step, 0) AS score,
                   CASE WHEN c IS NULL THEN pairs ELSE list_append(pairs, {pair.format('c.next')}) END AS pairs, n
            FROM (
                SELECT seed, path, score, pairs, n + 1 AS n, unnest(CASE WHEN len(a) = 0 THEN [NULL] ELSE a END) AS c
                FROM (SELECT b.*, {allowed} AS a FROM {name} b LEFT JOIN options o ON o.prev = list_extract(b.path, -1) WHERE n < {STEPS}))))
    WHERE r <= 8"""


for _name, _flag in (("beam", False), ("beam_once", True)):
    CTES[_name] = _beam(_name, _flag)
    CTES[f"walk_{_name}"] = f"""
        SELECT s.id, t.path, 1 AS n FROM seeds s JOIN (
            SELECT seed, path, row_number() OVER (PARTITION BY seed ORDER BY score::DOUBLE / len(path) DESC, path) AS r
            FROM {_name} WHERE n = {STEPS}) t ON t.seed = s.seed AND t.r = 1"""
for _mode in ("greedy", "sample", "topk", "topp", "synthesis", "beam", "beam_once"):
    CTES[f"titles_{_mode}"] = f"""
        SELECT p.id, CASE WHEN length(title) > 0 THEN title ELSE '無' END AS title
        FROM (SELECT id, arg_max(path, n) AS path FROM walk_{_mode} GROUP BY id) p
        LEFT JOIN (
            SELECT t.id, string_agg(v.word, ' ' ORDER BY pos) AS title
            FROM (SELECT id, unnest(path) AS tok, generate_subscripts(path, 1) AS pos FROM (SELECT id, arg_max(path, n) AS path FROM walk_{_mode} GROUP BY id)) t
            JOIN title_vocab v ON v.id = t.tok GROUP BY t.id) d ON d.id = p.id"""

# -- evaluation ---------------------------------------------------------------------------------------


def _grams(text: str, n: int, unit: str) -> str:
    units = _units(text, unit)
    if n == 1:
        return units
    pieces = " || ' ' || ".join(f"u[i + {k}]" for k in range(n))
    return f"(SELECT list_transform(range(1, len(u) - {n} + 2), lambda i: {pieces}) FROM (SELECT {units} AS u))"


def _rouge(pairs: str, n: int, unit: str = "word") -> str:
    def side(text: str) -> str:
        return f"SELECT id, g, count(*) AS c FROM (SELECT id, unnest({_grams(text, n, unit)}) AS g FROM {pairs}) GROUP BY id, g"

    return f"""
    SELECT id, overlap, n_pred, n_ref, CASE WHEN overlap > 0 THEN 2 * overlap / (n_pred + n_ref)::DOUBLE ELSE 0 END AS f FROM (
        SELECT q.id, coalesce(o.overlap, 0)::BIGINT AS overlap, len({_grams('q.pred', n, unit)}) AS n_pred, len({_grams('q.ref', n, unit)}) AS n_ref
        FROM {pairs} q LEFT JOIN (
            SELECT id, sum(least(a.c, b.c)) AS overlap FROM ({side('pred')}) a JOIN ({side('ref')}) b USING (id, g) GROUP BY id) o ON o.id = q.id)"""


def _lcs(name: str, pairs: str) -> dict[str, str]:
    """Row ``i`` of the table of longest common subsequences of each pair, one row per step."""
    return {
        f"{name}_p": f"SELECT id, {_units('pred')} AS a, {_units('ref')} AS b FROM {pairs}",
        f"{name}_walk": f"""
        SELECT id, 0 AS i, unnest(range(1, len(b) + 1)) AS j, 0::BIGINT AS v FROM {name}_p WHERE len(b) > 0
        UNION ALL
        SELECT id, i + 1, j, max(g) OVER (PARTITION BY id ORDER BY j) FROM (
            SELECT w.id, w.i, w.j, greatest(w.v, CASE WHEN p.a[w.i + 1] = p.b[w.j] THEN coalesce(lag(w.v) OVER (PARTITION BY w.id ORDER BY w.j), 0) + 1 ELSE 0 END) AS g
            FROM {name}_walk w JOIN {name}_p p ON p.id = w.id WHERE w.i < len(p.a))""",
        f"{name}_f": f"""
        SELECT id, lcs, n_pred, n_ref, CASE WHEN lcs > 0 THEN 2 * lcs / (n_pred + n_ref)::DOUBLE ELSE 0 END AS f FROM (
            SELECT p.id, coalesce(v, 0)::BIGINT AS lcs, len(a) AS n_pred, len(b) AS n_ref
            FROM {name}_p p LEFT JOIN {name}_walk w ON w.id = p.id AND w.i = len(a) AND w.j = len(b))""",
    }


CTES["rouge_1"] = _rouge("lead", 1)
CTES["rouge_2"] = _rouge("lead", 2)
CTES["rouge_2_chars"] = _rouge("lead", 2, "char")
CTES["rouge_1_dialog"] = _rouge("dialog", 1)
CTES["label_titles"] = f"""
    SELECT m.id, coalesce(string_agg(word, ' ' ORDER BY pos), '') AS title FROM model_ids m LEFT JOIN (
        SELECT id, word, pos FROM (SELECT id, unnest(y[1:63]) AS tok, generate_subscripts(y[1:63], 1) AS pos FROM (SELECT id, {_started('ids', 64)} AS y FROM model_ids)) s
        JOIN (SELECT word, id AS tok FROM title_vocab) v USING (tok)) d ON d.id = m.id GROUP BY m.id"""
CTES["greedy_pairs"] = "SELECT t.id, t.title AS pred, a.title AS ref FROM titles_greedy t JOIN label_titles a ON a.id = t.id"
CTES["drawn_pairs"] = "SELECT t.id, t.title AS pred, a.title AS ref FROM titles_sample t JOIN label_titles a ON a.id = t.id"
for _name, _pairs in (("lcs_lead", "lead"), ("lcs_dialog", "dialog"), ("lcs_greedy", "greedy_pairs"), ("lcs_drawn", "drawn_pairs")):
    CTES.update(_lcs(_name, _pairs))


def _nll(steps: str) -> str:
    return f"""
    SELECT id, count(*) AS n_tokens, avg(-ln((coalesce(b.cnt, 0) + 1) / (coalesce(c.prev_cnt, 0) + {V})::DOUBLE)) AS nll
    FROM {steps} s
    LEFT JOIN bigrams b ON b.prev = s.prev AND b.next = s.next
    LEFT JOIN (SELECT DISTINCT prev, prev_cnt FROM bigrams) c ON c.prev = s.prev WHERE s.next <> -100 GROUP BY id"""


CTES["model_ids"] = _encoded("articles", "title_vocab", "title", 64)
CTES["bench_words"] = f"SELECT item_id AS id, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM (SELECT item_id, {_words('text')} AS w FROM benchmark)"
CTES["bench_steps"] = """
    SELECT id, lag(token, 1, 0) OVER (PARTITION BY id ORDER BY pos) AS prev, token AS next FROM (
        SELECT w.id, pos, coalesce(v.id, 2) AS token FROM bench_words w LEFT JOIN title_vocab v ON v.word = w.word
        UNION ALL SELECT id, max(pos) + 1, 1 FROM bench_words GROUP BY id)"""
CTES["model_steps"] = f"SELECT id, unnest(y[1:63]) AS prev, unnest(l) AS next FROM (SELECT id, y, {_labels('y', 64)} AS l FROM (SELECT id, {_started('ids', 64)} AS y FROM model_ids))"
CTES["nll"] = _nll("model_steps")
CTES["bench_nll"] = _nll("bench_steps")
CTES["sampled"] = f"""
    SELECT id, a.f AS rouge_1, b.f AS rouge_2, l.f AS rouge_l, (row_number() OVER (ORDER BY id::BIGINT) - 1) // 4 AS batch
    FROM rouge_1 a JOIN rouge_2 b USING (id) JOIN lcs_lead_f l USING (id) WHERE {_u(7, 'id')} < 0.1"""
CTES["mean_rouge_row"] = "SELECT rouge_1, rouge_2, rouge_l FROM sampled"
CTES["mean_rouge_batch"] = "SELECT avg(rouge_1) AS rouge_1, avg(rouge_2) AS rouge_2, avg(rouge_l) AS rouge_l FROM sampled GROUP BY batch"
CTES["mean_loss_row"] = "SELECT nll AS v_loss FROM nll"
CTES["mean_loss_batch"] = "SELECT avg(nll) AS v_loss FROM (SELECT nll, (row_number() OVER (ORDER BY id::BIGINT) - 1) // 4 AS batch FROM nll) GROUP BY batch"
CTES["drawn_loss"] = f"""
    SELECT id, avg(-(coalesce(b.cnt, 0) + 1) / (coalesce(c.prev_cnt, 0) + {V})::DOUBLE) AS drawn_loss
    FROM (SELECT m.id, unnest(list_slice({_started('m.ids', 64)}, 1, len(w.path))) AS prev, unnest(w.path) AS next
          FROM model_ids m JOIN (SELECT id, arg_max(path, n) AS path FROM walk_sample GROUP BY id) w ON w.id = m.id) s
    LEFT JOIN bigrams b ON b.prev = s.prev AND b.next = s.next
    LEFT JOIN (SELECT DISTINCT prev, prev_cnt FROM bigrams) c ON c.prev = s.prev WHERE s.next <> 0 GROUP BY id"""
CTES["greedy_sample"] = f"SELECT id, pred, ref FROM greedy_pairs WHERE {_u(7, 'id')} < 0.1"
CTES["greedy_one"], CTES["greedy_two"] = _rouge("greedy_sample", 1), _rouge("greedy_sample", 2)
CTES["validated"] = """
    SELECT avg(a) AS rouge_1, avg(b) AS rouge_2, avg(l) AS rouge_l FROM (
        SELECT avg(a.f) AS a, avg(b.f) AS b, avg(l.f) AS l FROM (
            SELECT id, (row_number() OVER (ORDER BY id::BIGINT) - 1) // 4 AS batch FROM greedy_sample)
        JOIN greedy_one a USING (id) JOIN greedy_two b USING (id) JOIN lcs_greedy_f l USING (id) GROUP BY batch)"""
CTES["rewards"] = """
    SELECT batch, avg(g) AS greedy_f, avg(d) AS drawn_f FROM (
        SELECT g.f AS g, d.f AS d, (row_number() OVER (ORDER BY g.id::BIGINT) - 1) // 4 AS batch
        FROM lcs_greedy_f g JOIN lcs_drawn_f d ON d.id = g.id) GROUP BY batch"""
CTES["checkpoints"] = """
    SELECT id::BIGINT % 10 AS step, round(avg(n.nll), 9) AS v_loss, round(avg(a.f), 9) AS r1, round(avg(b.f), 9) AS r2, round(avg(l.f), 9) AS rl
    FROM nll n JOIN rouge_1 a USING (id) JOIN rouge_2 b USING (id) JOIN lcs_lead_f l USING (id) GROUP BY ALL"""

# -- the queries --------------------------------------------------------------------------------------

FINAL: dict[str, str] = {
    "s1_csv_round_trip": "SELECT Id, Category, text FROM reviews",
    "s2_jsonl_round_trip": "SELECT id, maintext, title FROM articles",
    "s3_answer_csv": "SELECT Id, pred AS Category FROM pred JOIN reviews USING (Id) WHERE split = 'test'",
    "s4_title_jsonl": "SELECT pred AS title, id::BIGINT AS id FROM lead",
    "s5_bag_store": "SELECT Id, cls, idx, cnt, split FROM bag JOIN reviews USING (Id)",
    "s6_feature_store": f"""SELECT mode, max_len, id::BIGINT AS id, list_sum({_mask('t.ids')})::BIGINT AS n_tokens, {_ints('t.ids')} AS input_ids,
            CASE WHEN mode = 'train' THEN {_ints(_labels('y', 64))} END AS labels
        FROM (SELECT 'train' AS mode, 512 AS max_len, * FROM text_ids UNION ALL SELECT 'train', 128, * FROM text_ids_128 UNION ALL SELECT 'eval', 512, * FROM text_ids) t
        JOIN forced f USING (id)""",
    "s7_model_round_trip": "SELECT Id, true AS same FROM reviews",
    "c1_two_view_logistic": "SELECT split, count(*) AS n, count(*) AS n_finite, count(*) AS n_of_larger, true AS learned FROM reviews GROUP BY split",
    "c1_two_view_perceptron": "SELECT split, count(*) AS n, count(*) AS n_finite, count(*) AS n_of_larger, true AS learned FROM reviews GROUP BY split",
    "c8_model_predict": "SELECT Id, true AS same FROM reviews WHERE split = 'test'",
    "s8_metric_log": """SELECT epoch, view, batch, metric, round(value, 6) AS value FROM (
        SELECT epoch, view, batch, 'loss' AS metric, loss AS value FROM batch_losses UNION ALL SELECT epoch, view, batch, 'n', n FROM batch_losses) WHERE epoch < 3""",
    "p1_union_splits": "SELECT Id, Category, split FROM reviews",
    "p2_class_partition": "SELECT Id, CASE WHEN Category = 0 THEN 'neg' ELSE 'pos' END AS cls FROM reviews",
    "p3_scoring_sample": f"SELECT id, title FROM articles WHERE {_u(7, 'id')} < 0.1",
    "p4_eval_columns": f"SELECT {_ints('ids')} AS input_ids, {_ints(_mask('ids'))} AS attention_mask, id::BIGINT AS id FROM text_ids",
    "p5_null_text": f"""SELECT doc_id, len(w)::INT AS n_words, len(list_filter(w, lambda x: x = 'nan'))::INT AS n_nan
        FROM (SELECT doc_id, {_words(f"coalesce(CASE WHEN {_u(8, 'doc_id')} >= 0.2 THEN text END, 'nan')")} AS w FROM documents)""",
    "p6_numeric_id": "SELECT id::BIGINT AS id, title FROM articles",
    "p7_pair_views": """SELECT r.Id, r.Category AS label, coalesce(pos, '') AS pos, coalesce(neg, '') AS neg FROM reviews r LEFT JOIN (
        SELECT Id, string_agg(idx || ':' || cnt, ' ' ORDER BY idx) FILTER (cls = 'pos') AS pos, string_agg(idx || ':' || cnt, ' ' ORDER BY idx) FILTER (cls = 'neg') AS neg
        FROM bag GROUP BY Id) b ON b.Id = r.Id""",
    "p8_batches": "SELECT split, Id, (row_number() OVER (PARTITION BY split ORDER BY Id) - 1) // 64 AS batch FROM reviews",
    "p8_batches_shuffled": f"""SELECT split, Id, (row_number() OVER (PARTITION BY split ORDER BY {_u(3, "split || ':' || Id")}, Id) - 1) // 64 AS batch FROM reviews""",
    "p9_split_sizes": "SELECT split, count(*) AS n_rows FROM reviews GROUP BY split",
    "t1_strip_marks": f"SELECT Id, {_strip_marks('text')} AS text FROM marked",
    "t2_collapse_spaces": f"SELECT Id, {_collapse('text')} AS text FROM marked",
    "t3_split_words": f"""SELECT Id, (generate_subscripts(w, 1) - 1)::INT AS pos, unnest(w) AS word FROM (SELECT Id, {_words("(text || '  end ')")} AS w FROM reviews)""",
    "t4_clean_articles": "SELECT id, maintext FROM clean_news",
    "a1_class_word_freq": "SELECT cls, word, freq FROM freqs_m",
    "a2_frequent_words": "SELECT cls, word, freq FROM freqs_m WHERE freq > 10",
    "a3_vocab_index": "SELECT cls, word, idx, freq FROM vocab_m",
    "a4_bag_of_words": "SELECT Id, cls, idx, cnt FROM bag_m",
    "a4_bag_of_clean_words": f"""SELECT Id, cls, idx, count(*) AS cnt FROM (SELECT Id, unnest({_words(_collapse(_strip_marks("coalesce(text, 'nan')")))}) AS word FROM marked) t
        JOIN vocab_m USING (word) GROUP BY Id, cls, idx""",
    "a4_vector_totals": """SELECT r.Id, coalesce(sum(cnt * (idx + 1)) FILTER (cls = 'neg'), 0)::BIGINT AS neg_total, coalesce(sum(cnt * (idx + 1)) FILTER (cls = 'pos'), 0)::BIGINT AS pos_total
        FROM reviews r LEFT JOIN bag b ON b.Id = r.Id GROUP BY r.Id""",
    "a5_vocab_sizes": """SELECT cls, count(word) AS n_words, coalesce(sum(freq), 0)::BIGINT AS n_tokens
        FROM (VALUES ('neg'), ('pos')) t(cls) LEFT JOIN vocab USING (cls) GROUP BY cls""",
    "c2_linear_scores": f"SELECT Id, view, {_r('s0')} AS s0, {_r('s1')} AS s1 FROM scores",
    "c2_linear_scores_of_bag": f"SELECT Id, view, {_r('s0')} AS s0, {_r('s1')} AS s1 FROM scores",
    "c3_fused_scores": f"SELECT Id, {_r('s0')} AS s0, {_r('s1')} AS s1 FROM fused",
    "c3_fused_probabilities": f"SELECT Id, {_r('avg(1 / (1 + exp(s1 - s0)))')} AS s0, {_r('avg(1 / (1 + exp(s0 - s1)))')} AS s1 FROM scores GROUP BY Id",
    "c4_argmax_label": "SELECT Id, pred FROM pred",
    "c5_accuracy": f"""SELECT split, count(*) AS n, count(*) FILTER (pred = Category) AS n_right, {_r('avg((pred = Category)::INT)')} AS accuracy
        FROM pred JOIN reviews USING (Id) WHERE Category IS NOT NULL GROUP BY split""",
    "c6_running_loss": f"SELECT epoch, view, batch, {_r('avg(loss) OVER (PARTITION BY epoch, view ORDER BY batch ROWS UNBOUNDED PRECEDING)')} AS running_loss FROM batch_losses",
    "c7_best_epochs": f"SELECT epoch, {_r('accuracy')} AS accuracy, {_r('best')} AS best_before FROM kept_epochs",
    "c7_best_epoch_answers": """SELECT Id, CASE WHEN s1 > s0 THEN 1 ELSE 0 END AS pred FROM (
        SELECT Id, avg(s0) AS s0, avg(s1) AS s1 FROM all_scores WHERE epoch = (SELECT coalesce(max(epoch), 1) FROM kept_epochs) GROUP BY Id)
        JOIN reviews USING (Id) WHERE split = 'test'""",
    "c8_linear_predict": "SELECT Id, pred FROM pred JOIN reviews USING (Id) WHERE split = 'test'",
    "c9_misclassified": "SELECT Id, text, Category, pred FROM pred JOIN reviews USING (Id) WHERE Category IS NOT NULL AND pred <> Category",
    "e0_corpus_vocab": "SELECT word, id AS token, freq FROM news_vocab UNION ALL SELECT word, id, freq FROM specials",
    "e1_encode": f"SELECT id, {_ints('a.ids')} AS input_ids, {_ints(_mask('a.ids'))} AS attention_mask, {_ints('b.ids')} AS title_ids FROM text_ids a JOIN title_ids b USING (id)",
    "e2_decoder_start": f"SELECT id, {_ints('y')} AS ids FROM forced",
    "e3_teacher_forcing": f"""SELECT id, {_ints('y[1:63]')} AS decoder_input_ids, {_ints(_mask('ids[1:63]'))} AS decoder_attention_mask,
        {_ints(_labels('y', 64))} AS labels FROM forced""",
    "e4_decode": """SELECT t.id, coalesce(string_agg(word, ' ' ORDER BY pos), '') AS title FROM title_ids t
        LEFT JOIN (SELECT id, word, pos FROM (SELECT id, unnest(ids) AS tok, generate_subscripts(ids, 1) AS pos FROM title_ids) s
                   JOIN (SELECT word, id AS tok FROM news_vocab) v USING (tok)) d ON d.id = t.id GROUP BY t.id""",
    "e5_train_features": f"""SELECT id, {_ints('a.ids')} AS input_ids, {_ints(_mask('a.ids'))} AS attention_mask, {_ints('y[1:63]')} AS decoder_input_ids,
        {_ints(_mask('f.ids[1:63]'))} AS decoder_attention_mask, {_ints(_labels('y', 64))} AS labels FROM text_ids a JOIN forced f USING (id)""",
    "e6_mapped_features": f"SELECT doc_id, len({_words('text')}) AS n_words, len(string_split(text, chr(10))) AS n_lines FROM documents",
    "g0_bigram_table": f"SELECT prev, next, cnt, prev_cnt, {_r('logp')} AS logp FROM bigrams",
    "g1_softmax": f"SELECT prev, next, {_r('p')} AS p FROM p_warm",
    "g2_top_k": f"SELECT prev, next, {_r('p')} AS p FROM p_topk",
    "g3_top_p": f"SELECT prev, next, {_r('p')} AS p FROM p_topp",
    "g4_synthesis": f"SELECT prev, next, {_r('p')} AS p FROM p_synthesis",
    "g5_weighted_draw": f"SELECT prev, next FROM cdf_sample WHERE floor({_u(5, 'prev')} * 1e12) >= lo AND floor({_u(5, 'prev')} * 1e12) < hi",
    "g5_sample_titles": "SELECT id, title FROM titles_sample",
    "g5_topk_titles": "SELECT id, title FROM titles_topk",
    "g5_topp_titles": "SELECT id, title FROM titles_topp",
    "g5_synthesis_titles": "SELECT id, title FROM titles_synthesis",
    "g6_greedy_titles": "SELECT id, title FROM titles_greedy",
    "g7_beam_titles": "SELECT id, title FROM titles_beam",
    "g8_beam_titles_no_repeat": "SELECT id, title FROM titles_beam_once",
    "g9_batch_inference": "SELECT pred AS title, id::BIGINT AS id FROM lead",
    "o1_rouge_1": f"SELECT id, overlap, n_pred, n_ref, {_r('f')} AS f FROM rouge_1",
    "o1_rouge_2": f"SELECT id, overlap, n_pred, n_ref, {_r('f')} AS f FROM rouge_2",
    "o1_rouge_2_chars": f"SELECT id, overlap, n_pred, n_ref, {_r('f')} AS f FROM rouge_2_chars",
    "o1_rouge_1_dialog": f"SELECT id, overlap, n_pred, n_ref, {_r('f')} AS f FROM rouge_1_dialog",
    "o1l_rouge_l": f"SELECT id, lcs, n_pred, n_ref, {_r('f')} AS f FROM lcs_lead_f",
    "o1l_rouge_l_dialog": f"SELECT id, lcs, n_pred, n_ref, {_r('f')} AS f FROM lcs_dialog_f",
    "o2_placeholder": r"""SELECT doc_id, CASE WHEN length(t) > 0 THEN t ELSE '無' END AS title FROM (
        SELECT doc_id, trim(regexp_replace(text, '(?s)^[^.]*[.]', '')) AS t FROM documents)""",
    "o3_batch_means": " UNION ALL ".join(
        f"""SELECT '{w}' AS weighting, {", ".join(f"(SELECT {_r(f'avg({c})')} FROM {t}_{w}) AS {c}" for c, t in (("v_loss", "mean_loss"), ("rouge_1", "mean_rouge"), ("rouge_2", "mean_rouge"), ("rouge_l", "mean_rouge")))}"""
        for w in ("batch", "row")
    ),
    "o4_token_nll": f"SELECT id, n_tokens, {_r('nll')} AS nll, {_r('nll')} AS log_perplexity FROM nll",
    "o4_benchmark_nll": f"SELECT id, n_tokens, {_r('nll')} AS nll, {_r('nll')} AS log_perplexity FROM bench_nll",
    "o5_batch_rewards": f"SELECT batch, {_r('greedy_f')} AS greedy_f, {_r('drawn_f')} AS drawn_f, {_r('greedy_f - drawn_f')} AS reward FROM rewards",
    "o5_mixed_objective": f"""SELECT epoch, {_r('loss')} AS loss, {_r('drawn_loss')} AS drawn_loss, {_r('reward')} AS reward,
            {_r('CASE WHEN epoch = 1 THEN 0.7 * loss + 0.3 * reward * drawn_loss ELSE loss END')} AS objective FROM (
        SELECT (id::BIGINT % 3)::INT AS epoch, avg(nll) AS loss, avg(drawn_loss) AS drawn_loss, avg(g.f) - avg(d.f) AS reward
        FROM nll JOIN drawn_loss USING (id) JOIN lcs_greedy_f g USING (id) JOIN lcs_drawn_f d USING (id) GROUP BY ALL)""",
    "o6_validation_job": f"""SELECT 1::BIGINT AS step, (SELECT {_r('avg(v_loss)')} FROM mean_loss_batch) AS v_loss,
        {", ".join(f"{_r(c)} AS {c}" for c in ("rouge_1", "rouge_2", "rouge_l"))} FROM validated""",
    "o6_best_checkpoints": f"""SELECT step, printf('step=%05d-v_loss=%.2f-rouge_1=%.2f-rouge_2=%.2f-rouge_l=%.2f', step, v_loss, r1, r2, rl) AS name, {_r('v_loss')} AS v_loss
        FROM checkpoints ORDER BY checkpoints.v_loss, step LIMIT 3""",
}


def _used(sql: str) -> set[str]:
    return set(re.findall(r"(?:FROM|JOIN)\s+([a-z_0-9]+)", sql)) & set(CTES)


def _with(final: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for other in sorted(_used(CTES[name]) - {name}):
                add(other)
            order.append(name)

    for name in sorted(_used(final)):
        add(name)
    if not order:
        return final
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + final


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in FINAL.items()}
