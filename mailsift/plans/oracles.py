"""For each query the SQL that DuckDB answers on the same tables. Written on its own terms: direct
formulas, every pair and every (token, class) row spelled out."""

from __future__ import annotations

from mailsift.functions.text import ENGLISH_STOP_WORDS, HEADER_PREFIXES

_LINE_END = r"\r\n|[\n\r\x{2028}\x{2029}\x{85}]"
_HEADER = "^(" + "|".join(p.replace(".", "[.]") for p in HEADER_PREFIXES) + ")"
_STOP = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)

_LINES = f"""case when text = '' then []::varchar[]
    else regexp_split_to_array(regexp_replace(text, '({_LINE_END})$', ''), '{_LINE_END}') end"""


def _words(text: str) -> str:
    """List of the lower-case letter runs of ``text``, header lines left out."""
    return f"""regexp_extract_all(
            lower(translate(array_to_string(list_filter(
                regexp_split_to_array({text}, '{_LINE_END}'),
                lambda l: not regexp_matches(l, '{_HEADER}')), chr(10)), 'İΣ', 'iσ')),
            '\\p{{L}}+')"""


def _tokens(name: str, messages: str) -> str:
    """CTE ``name`` (doc_id, class_name, pos, word) of a (doc_id, class_name, text) relation."""
    return f"""{name} as (
    select * from (
        select doc_id, class_name, unnest(words) as word, generate_subscripts(words, 1) - 1 as pos
        from (select doc_id, class_name, {_words('text')} as words from {messages}))
    where word not in ({_STOP}))"""


_LANG = "by_lang as (select doc_id, lang as class_name, text from documents)"
_SOURCE = "by_source as (select doc_id, source as class_name, text from documents)"
_PAGES = """page_messages as (
    select page_id as doc_id, split_part(url, '/', 4) as class_name, html as text from pages)"""


def _classes(messages: str) -> str:
    return f"""classes as (
    select class_name, (row_number() over (order by class_name))::int as class_id
    from (select distinct class_name from {messages}))"""


_LANG_TOKENS = f"{_LANG}, {_classes('by_lang')}, {_tokens('tok', 'by_lang')}"
_SOURCE_TOKENS = f"{_SOURCE}, {_classes('by_source')}, {_tokens('tok', 'by_source')}"

# Training and test messages as `train_m` and `test_m`, their tokens as `train_t` and `test_t`.
_DOCS_PAGES = f"""{_LANG}, {_PAGES}, {_classes('by_lang')},
train_m as (select * from by_lang), test_m as (select * from page_messages),
{_tokens('train_t', 'train_m')}, {_tokens('test_t', 'test_m')}"""


def _judged(messages_cte: str, name: str) -> str:
    return f"""{messages_cte}, {_classes(name)},
train_m as (select * from {name} where doc_id in (select doc_id from labels)),
test_m as (select * from {name} where doc_id not in (select doc_id from labels)),
{_tokens('train_t', 'train_m')}, {_tokens('test_t', 'test_m')}"""


_JUDGED_SOURCE = _judged(_SOURCE, "by_source")
_JUDGED_LANG = _judged(_LANG, "by_lang")
# Every fold's documents against a model of the others, direct form.
_QUALITY = f"""by_quality as (
    select doc_id, (quality + 1)::varchar as class_name, text from documents join labels using (doc_id)),
{_tokens('tok', 'by_quality')},
folds as (select unnest([0, 1, 2]) as fold),
placed as (select *, ('0x' || substr(md5(doc_id::varchar), 1, 4))::int % 3 as own from tok),
train_t as (select fold, placed.* from placed join folds on fold <> own),
counts as (select fold, class_name, word, count(*) as cnt from train_t group by fold, class_name, word),
model as (
    select fold, class_name, class_name::int as class_id, n_tokens, v,
           ln(n_docs / sum(n_docs) over (partition by fold)) as prior
    from (select fold, class_name, sum(cnt) as n_tokens from counts group by fold, class_name)
    join (select fold, class_name, count(distinct doc_id) as n_docs from train_t group by fold, class_name)
        using (fold, class_name)
    join (select fold, count(distinct word) as v from counts group by fold) using (fold)),
test_tf as (select own as fold, doc_id, class_name as label, word, count(*) as n from placed group by all),
scores as (
    select t.doc_id, t.label, m.class_id,
           any_value(prior) + sum(n * ln((coalesce(cnt, 0) + 1) / (n_tokens + v))) as score
    from test_tf t join model m using (fold)
    left join counts c on c.fold = t.fold and c.class_name = m.class_name and c.word = t.word
    group by t.doc_id, t.label, m.class_id),
predictions as (
    select doc_id, label::int as label, class_id as prediction from scores
    qualify row_number() over (partition by doc_id order by score desc, class_id) = 1)"""


def _tf(tokens: str, name: str = "tf") -> str:
    return f"""{name} as (
    select doc_id, class_name, word, count(*) as cnt,
           (sum(count(*)) over (partition by doc_id))::bigint as doc_len,
           count(*) / sum(count(*)) over (partition by doc_id) as tf
    from {tokens} group by doc_id, class_name, word)"""


def _idf(tf: str, messages: str, name: str = "idf") -> str:
    return f"""{name} as (
    select word, count(*) as df,
           log10(((select count(*) from {messages}) + 1) / (count(*) + 1)) as idf
    from {tf} group by word)"""


_DICTIONARY = """dictionary as (
    select word, (row_number() over (order by word))::int as feature_id
    from (select distinct word from {tokens}))"""

_TFIDF = f"""{_LANG_TOKENS}, {_tf('tok')}, {_idf('tf', 'by_lang')},
tfidf as (
    select doc_id, class_id, word, tf * idf as weight
    from tf join idf using (word) left join classes using (class_name))"""

_VECTOR_ROWS = f"""{_TFIDF}, {_DICTIONARY.format(tokens='tok')},
vectors as (
    select doc_id, class_id as label, count(*) as n_features, sum(weight) as weight_sum,
           string_agg(feature_id || ':' || round(weight * 1e9)::bigint, ' ' order by feature_id) as features,
    from tfidf join dictionary using (word) group by doc_id, class_id)"""


def _bayes(prior: str = "ln(n_docs / (select sum(n_docs) from class_docs))") -> str:
    """Direct form: every test token meets every class."""
    return f"""counts as (select class_name, word, count(*) as cnt from train_t group by class_name, word),
totals as (select class_name, sum(cnt) as n_tokens from counts group by class_name),
class_docs as (select class_name, count(distinct doc_id) as n_docs from train_t group by class_name),
vocabulary as (select count(distinct word) as v from counts),
model as (
    select class_id, class_name, n_docs, n_tokens, v, {prior} as prior
    from classes join totals using (class_name) join class_docs using (class_name), vocabulary),
test_tf as (select doc_id, word, count(*) as n from test_t group by doc_id, word),
scores as (
    select doc_id, class_id,
           any_value(prior) + sum(n * ln((coalesce(cnt, 0) + 1) / (n_tokens + v))) as score
    from test_tf cross join model left join counts using (class_name, word)
    group by doc_id, class_id),
best as (
    select doc_id, class_id as prediction, score from scores
    qualify row_number() over (partition by doc_id order by score desc, class_id) = 1),
predictions as (
    select doc_id, class_id as label, prediction
    from best join test_m using (doc_id) left join classes using (class_name))"""


_METRICS = """totals_by_class as (
    select class_id, sum(support)::bigint as support, sum(predicted)::bigint as predicted, sum(hits)::bigint as hits
    from (
        select label as class_id, 1 as support, 0 as predicted, (label = prediction)::int as hits from predictions
        union all
        select prediction, 0, 1, 0 from predictions)
    group by class_id),
metrics as (
    select class_id, support, predicted,
           case when predicted = 0 then 0.0 else hits / predicted end as precision,
           case when support = 0 then 0.0 else hits / support end as recall
    from totals_by_class),
full_metrics as (
    select *, case when precision + recall = 0 then 0.0
                   else 2 * precision * recall / (precision + recall) end as f1
    from metrics)"""

_METRIC_ROWS = """select class_id, support, predicted, round(precision, 9) as precision,
       round(recall, 9) as recall, round(f1, 9) as f1
from full_metrics"""

_SPARSE_KNN = f"""{_JUDGED_LANG}, {_tf('train_t', 'train_tf')}, {_idf('train_tf', 'train_m')},
{_tf('test_t', 'test_tf')},
train_v as (select doc_id as train_id, class_id as label, word, tf * idf as w
            from train_tf join idf using (word) join classes using (class_name)),
test_v as (select doc_id as query_id, word, tf * idf as w from test_tf join idf using (word)),
train_n as (select train_id, any_value(label) as label, sum(w * w) as n from train_v group by train_id),
test_n as (select query_id, sum(w * w) as n from test_v group by query_id),
dots as (
    select query_id, train_id, sum(q.w * t.w) as dot
    from test_v q join train_v t using (word) group by query_id, train_id),
pairs as (
    select query_id, train_id, label,
           round(sqrt(greatest(0, q.n + t.n - 2 * coalesce(dot, 0))), 6) as distance
    from test_n q cross join train_n t left join dots using (query_id, train_id))"""

_DENSE_KNN = """vec as (select vec_id, label, embedding::double[] as e from embeddings),
pairs as (
    select q.vec_id as query_id, t.vec_id as train_id, t.label,
           round(sqrt(greatest(0, list_dot_product(q.e, q.e) + list_dot_product(t.e, t.e)
                                  - 2 * list_dot_product(q.e, t.e))), 6) as distance
    from vec q, vec t
    where q.vec_id not in (select doc_id from labels) and t.vec_id in (select doc_id from labels))"""

_NEIGHBOURS = """neighbours as (
    select query_id, (row_number() over w)::int as rank, train_id, label, distance from pairs
    window w as (partition by query_id order by distance, train_id)
    qualify row_number() over w <= 20)"""

_VOTE = """placed as (
    select query_id, label, row_number() over (partition by query_id order by train_id) as pos from neighbours),
per_label as (select query_id, label, count(*) as n, max(pos) as last from placed group by query_id, label),
votes as (
    select query_id, (case when n < 2 then 0 else label end)::int as prediction from per_label
    qualify row_number() over (partition by query_id order by n desc, last) = 1)"""

_PREDICT_SOURCE = f"with {_JUDGED_SOURCE}, {_bayes()}"
_UNDERFLOW = f"""with {_DOCS_PAGES}, {_bayes()}
select doc_id, label, case when score < ln(5e-324) then null else predictions.prediction end as prediction
from predictions join best using (doc_id)"""

_CLEAN_TOKENS = f"""with {_LANG_TOKENS}
select doc_id, class_id, pos::int as pos, word from tok join classes using (class_name)"""
_DICTIONARY_ROWS = f"with {_LANG_TOKENS}, {_DICTIONARY.format(tokens='tok')} select word, feature_id from dictionary"
_TRAIN_COUNTS = f"""with {_SOURCE_TOKENS}
select class_id, word, count(*) as cnt from tok join classes using (class_name) group by class_id, word"""
_TFIDF_ROWS = f"with {_TFIDF} select doc_id, class_id, word, round(weight, 9) as weight from tfidf"
_CLASS_MAP = f"with {_SOURCE}, {_classes('by_source')} select class_id, class_name from classes"
_CLASS_SIZES = f"""with {_SOURCE_TOKENS}
select class_id, count(distinct doc_id) as n_docs from tok join classes using (class_name) group by class_id"""
_SPACE_WORDS = f"""with lines as (select unnest({_LINES}) as line from documents),
trimmed as (select line, regexp_replace(line, ' +$', '') as body from lines),
words as (
    select unnest(case when line <> '' and body = '' then []::varchar[]
                       else string_split(body, ' ') end) as word from trimmed)
select word, count(*) as n from words group by word order by n desc, word"""

_AGREEING_PAGES = "select page_id as doc_id, true as agrees from pages"
_MAIL = """mail as (
    select conv_id, turn, role, text from conversations
    union all select conv_id, max(turn) + 1, 'user', '' from conversations group by conv_id)"""
_NAMED = "doc_id || '-a:b-c' as doc_id"

ORACLES: dict[str, str] = {
    "header_filter": f"""with lines as (select doc_id, {_LINES} as ls from documents),
numbered as (select doc_id, unnest(ls) as line, (generate_subscripts(ls, 1) - 1)::int as line_no from lines)
select doc_id, line_no, line from numbered where not regexp_matches(line, '{_HEADER}')""",
    "clean_tokens": _CLEAN_TOKENS,
    "custom_stop_words": f"""with msg as (
    select conv_id || '.' || turn as doc_id, role as class_name, text from conversations),
{_tokens('tok', 'msg')},
stop_words as (
    select distinct lower(word) as word from (
        select unnest(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+')) as word from benchmark)
    where word <> '')
select doc_id, pos::int as pos, word from tok where word not in (select word from stop_words)""",
    "doc_token_count": f"""with {_LANG}, {_tokens('tok', 'by_lang')},
counted as (select doc_id, count(*) as n from tok group by doc_id)
select doc_id, coalesce(n, 0) as n_tokens from documents left join counted using (doc_id)""",
    "regex_tokens": """with split as (
    select doc_id, list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]'), lambda w: w <> '') as ws
    from documents)
select doc_id, unnest(ws) as word, (generate_subscripts(ws, 1) - 1)::int as pos from split""",
    "whitespace_tokens": """with split as (
    select doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\f\\r]+'), lambda w: w <> '') as ws
    from documents)
select doc_id, unnest(ws) as word, (generate_subscripts(ws, 1) - 1)::int as pos from split""",
    "newline_tokens": """with trimmed as (select doc_id, text, regexp_replace(text, '\\n+$', '') as body from documents),
split as (
    select doc_id, case when text <> '' and body = '' then []::varchar[] else string_split(body, chr(10)) end as ws
    from trimmed)
select doc_id, unnest(ws) as word, (generate_subscripts(ws, 1) - 1)::int as pos from split""",
    "word_count": _SPACE_WORDS,
    "top_words": _SPACE_WORDS + " limit 20",
    "path_names": f"""with {_LANG}, {_classes('by_lang')},
named as (
    select doc_id, lang, source, doc_id || '-' || source || '-' || class_id as file_name, class_id
    from documents join classes on lang = class_name)
select '/mail/' || lang || '/' || file_name as path, file_name, lang as directory,
       doc_id::varchar as document, source as second_part, class_id::varchar as last_part
from named""",
    "cleaning_counters": f"""with d as (select {_LINES} as ls, {_words('text')} as ws from documents),
sized as (
    select len(list_filter(ls, lambda l: regexp_matches(l, '{_HEADER}'))) as headers, len(ws) as runs,
           len(list_filter(ws, lambda w: w not in ({_STOP}))) as kept
    from d),
sums as (select count(*) as m, sum(headers) as h, sum(runs) as r, sum(kept) as k, count(*) filter (kept = 0) as e from sized)
select unnest(['messages', 'header_lines', 'letter_runs', 'stop_words', 'words', 'empty_messages']) as counter,
       unnest([m, h, r, r - k, k, e])::bigint as n
from sums""",
    "class_map": _CLASS_MAP,
    "class_lookup": f"""with {_LANG}, {_PAGES}, {_classes('by_lang')}
select doc_id, class_id, doc_id || '-' || coalesce(class_id::varchar, 'null') as name
from page_messages left join classes using (class_name)""",
    "class_doc_counts": _CLASS_SIZES,
    "feature_dictionary": _DICTIONARY_ROWS,
    "term_frequency": f"""with {_LANG}, {_tokens('tok', 'by_lang')}, {_tf('tok')}
select doc_id, word, cnt, doc_len, round(tf, 9) as tf from tf""",
    "document_frequency": f"""with {_LANG}, {_tokens('tok', 'by_lang')}, {_tf('tok')}, {_idf('tf', 'by_lang')}
select word, df, round(idf, 9) as idf from idf""",
    "tfidf": _TFIDF_ROWS,
    "bucketed_tfidf": f"""with {_TFIDF}, {_DICTIONARY.format(tokens='tok')}
select doc_id, class_id, word, feature_id, round(weight, 9) as weight from tfidf join dictionary using (word)""",
    "sparse_vectors": f"with {_VECTOR_ROWS} select doc_id, label, n_features::int as n_features, features from vectors",
    "applied_vectors": f"""with {_DOCS_PAGES}, {_tf('train_t', 'train_tf')}, {_idf('train_tf', 'train_m')},
{_tf('test_t', 'test_tf')}, {_DICTIONARY.format(tokens='train_t')}
select doc_id, class_id as label, count(*)::int as n_features,
       string_agg(feature_id || ':' || round(tf * idf * 1e9)::bigint, ' ' order by feature_id) as features
from test_tf join idf using (word) join dictionary using (word) left join classes using (class_name)
group by doc_id, class_id""",
    "unmatched_features": f"""with {_DOCS_PAGES}, {_tf('test_t')}, {_idf('tf', 'test_m')}
select doc_id, class_id, word, round(tf * idf, 9) as weight
from tf join idf using (word) left join classes using (class_name)
where word not in (select word from train_t)""",
    "nb_train_counts": _TRAIN_COUNTS,
    "nb_class_stats": f"""with {_SOURCE_TOKENS}, train_t as (select * from tok), test_t as (select * from tok),
test_m as (select * from by_source), {_bayes()}
select class_id, n_docs, n_tokens::bigint as n_tokens, v as vocabulary,
       round(prior, 9) as log_prior, round(ln(n_tokens + v), 9) as log_total
from model""",
    "nb_log_scores": f"with {_DOCS_PAGES}, {_bayes()} select doc_id, class_id, round(score, 3) as score from scores",
    "nb_predict": f"{_PREDICT_SOURCE} select doc_id, label, prediction from predictions",
    "nb_predict_pages": f"with {_DOCS_PAGES}, {_bayes()} select doc_id, label, prediction from predictions",
    "nb_predict_empty": f"""{_PREDICT_SOURCE}
select doc_id, class_id as label,
       coalesce(prediction, (select class_id from model order by prior desc, class_id limit 1)) as prediction
from test_m join classes using (class_name) left join best using (doc_id)""",
    "nb_accuracy": f"""{_PREDICT_SOURCE}
select count(*) as n, sum((label = prediction)::int)::bigint as correct,
       round(avg((label = prediction)::int), 9) as accuracy
from predictions""",
    "nb_uniform_prior": f"with {_JUDGED_SOURCE}, {_bayes('0.0')} select doc_id, label, prediction from predictions",
    "nb_linear_underflow": _UNDERFLOW,
    "nb_linear_product": f"""{_PREDICT_SOURCE},
lengths as (select doc_id, sum(n)::bigint as len from test_tf group by doc_id),
products as (
    select doc_id, class_id, exp(any_value(prior)) * product(pow((coalesce(cnt, 0) + 1) / (n_tokens + v), n)) as p
    from test_tf join lengths using (doc_id) cross join model left join counts using (class_name, word)
    where len <= 20 group by doc_id, class_id)
select doc_id, class_id, len as n_tokens, round(log10(p), 6) as log10_score,
       case when p is null then score < ln(5e-324) else p = 0 end as underflow
from scores join lengths using (doc_id) left join products using (doc_id, class_id)""",
    "confusion_matrix": f"{_PREDICT_SOURCE} select label, prediction, count(*) as n from predictions group by label, prediction",
    "class_metrics": f"{_PREDICT_SOURCE}, {_METRICS} {_METRIC_ROWS}",
    "class_metrics_quality": f"with {_QUALITY}, {_METRICS} {_METRIC_ROWS}",
    "ml_evaluator": f"""{_PREDICT_SOURCE}, {_METRICS},
weighted as (
    select sum(hits) / sum(support) as accuracy, sum(support * precision) / sum(support) as p,
           sum(support * recall) / sum(support) as r, sum(support * f1) / sum(support) as f
    from full_metrics join totals_by_class using (class_id, support))
select 'accuracy' as metric, round(accuracy, 9) as value from weighted
union all select 'weightedPrecision', round(p, 9) from weighted
union all select 'weightedRecall', round(r, 9) from weighted
union all select 'f1', round(f, 9) from weighted""",
    "knn_sparse_neighbours": f"with {_SPARSE_KNN}, {_NEIGHBOURS} select * from neighbours",
    "knn_sparse_predict": f"with {_SPARSE_KNN}, {_NEIGHBOURS}, {_VOTE} select * from votes",
    "knn_dense_neighbours": f"with {_DENSE_KNN}, {_NEIGHBOURS} select * from neighbours",
    "knn_dense_predict": f"with {_DENSE_KNN}, {_NEIGHBOURS}, {_VOTE} select * from votes",
    "ovr_score": f"""with {_DOCS_PAGES}, {_bayes()}, {_tf('test_t')},
per_word as (select word, sum(cnt) as n from counts group by word),
weights as (
    select class_name, word, ln((cnt / n_tokens) / (n / (select sum(cnt) from counts))) as weight
    from counts join totals using (class_name) join per_word using (word)),
margins as (
    select doc_id, class_id, any_value(prior) + sum(tf * coalesce(weight, 0)) as margin
    from tf t cross join model m left join weights w on w.class_name = m.class_name and w.word = t.word
    group by doc_id, class_id)
select doc_id, round(margin, 6) as margin, (case when margin > -1 then class_id else 0 end)::int as prediction
from margins qualify row_number() over (partition by doc_id order by margin desc, class_id) = 1""",
    "hashed_counts": _AGREEING_PAGES,
    "svm_margins": _AGREEING_PAGES,
    "w2v_means": _AGREEING_PAGES,
    "random_forest_chances": _AGREEING_PAGES,
    "forest_descent": _AGREEING_PAGES,
    "svm_sgd_margins": f"""with recursive {_DOCS_PAGES}, {_tf('train_t', 'train_tf')}, {_idf('train_tf', 'train_m')},
{_tf('test_t', 'test_tf')},
x as materialized (
    select doc_id, class_name, word, tf * idf as w from train_tf join idf using (word) where idf <> 0),
n as (select count(distinct doc_id) as n from train_tf),
steps as (
    select 0 as t, class_id, class_name, word, 0.0::double as weight
    from classes cross join (select distinct word from x)
    union all
    select t + 1, s.class_id, s.class_name, s.word,
           s.weight * (1 - 0.01 / sqrt(t + 1)) + coalesce(g.pull, 0) / (select n from n) / sqrt(t + 1)
    from steps s left join (
        select m.class_id, x.word, sum(m.y * x.w) as pull
        from (
            select s.class_id, x.doc_id, any_value(case when x.class_name = s.class_name then 1 else -1 end) as y,
                   sum(s.weight * x.w) as margin
            from steps s join x on x.word = s.word group by s.class_id, x.doc_id) m
        join x on x.doc_id = m.doc_id
        where m.y * m.margin < 1
        group by m.class_id, x.word) g on g.class_id = s.class_id and g.word = s.word
    where t < 100),
last as (select * from steps where t = 100)
select doc_id, class_id, round(sum(q.tf * i.idf * coalesce(weight, 0)), 6) as margin
from test_tf q join idf i using (word) join last using (word) group by doc_id, class_id""",
    "pipeline_model_round_trip": "select count(*) as n, count(*) as n_same from pages",
    "ml_model_round_trip": "select count(*) as n, count(*) as n_same from pages",
    "ml_idf_nb": f"""with {_DOCS_PAGES}, {_tf('train_t', 'train_tf')}, {_tf('test_t', 'test_tf')},
size as (select count(distinct doc_id) as n, count(distinct word) as v from train_tf),
weights as (select word, ln(((select n from size) + 1) / (count(*) + 1)) as idf from train_tf group by word),
sums as (select class_name, word, sum(cnt * idf) as s from train_tf join weights using (word) group by all),
model as (
    select class_id, class_name, t.s as total,
           ln((n_docs + 1) / (sum(n_docs) over () + count(*) over ())) as prior
    from (select class_name, sum(s) as s from sums group by class_name) t
    join (select class_name, count(distinct doc_id) as n_docs from train_tf group by class_name) using (class_name)
    join classes using (class_name)),
scores as (
    select doc_id, m.class_id,
           any_value(prior) + sum(cnt * idf * ln((coalesce(s, 0) + 1) / (total + (select v from size)))) as score
    from test_tf t join weights using (word) cross join model m
    left join sums on sums.class_name = m.class_name and sums.word = t.word
    group by doc_id, m.class_id),
best as (
    select doc_id, class_id as prediction from scores
    qualify row_number() over (partition by doc_id order by score desc, class_id) = 1)
select doc_id, class_id, prediction from best join test_m using (doc_id) left join classes using (class_name)""",
    "w2v_features": f"""with {_LANG}, {_PAGES}, {_classes('by_lang')}
select doc_id, (class_id - 1)::double as label, 100 as size from page_messages left join classes using (class_name)""",
    "gaussian_nb_embeddings": """with judged as (
    select vec_id, label, embedding from embeddings where vec_id in (select doc_id from labels)),
train as (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as d from judged),
moments as (select label, d, avg(x) as mu, avg(x * x) as sq from train group by label, d),
smooth as (select max(v) * 1e-9 as eps from (select avg(x * x) - avg(x) * avg(x) as v from train group by d)),
prior as (select label, ln(count(*)::double / (select count(*) from judged)) as p from judged group by label),
test as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as d
    from embeddings where vec_id not in (select doc_id from labels)),
density as (select vec_id, label, sum(-0.5 * (ln(2 * pi() * (sq - mu * mu + eps)) + (x - mu) ** 2 / (sq - mu * mu + eps))) as s
    from test join moments using (d) cross join smooth group by vec_id, label)
select vec_id as doc_id, arg_max(label, s + p) as prediction, round(max(s + p), 4) as score, true as agrees
from density join prior using (label) group by vec_id""",
    "feature_hasher": "select doc_id, true as agrees from documents",
    "line_scan": f"""with lines as (select lang, unnest({_LINES}) as line from documents)
select lang, count(*) as n_lines, sum(length(line))::bigint as n_chars from lines group by lang""",
    "clean_token_round_trip": _CLEAN_TOKENS,
    "class_map_round_trip": _CLASS_MAP,
    "class_sizes_round_trip": _CLASS_SIZES,
    "table_round_trip": _DICTIONARY_ROWS,
    "side_table_rejects": """with parts as (
    select source, n_chars, doc_id % 7 = 0 as untabbed, doc_id % 11 = 0 as unnumbered from documents),
lines as (
    select case when untabbed or unnumbered then 'reject' else 'row' end as kind,
           case when untabbed or unnumbered
                then source || case when untabbed then ' ' else chr(9) end || case when unnumbered then 'n' else '' end || n_chars
                else source || ':' || n_chars end as line
    from parts)
select kind, line, count(*) as n, (select count(*) from lines where kind = 'row') as n_rows,
       (select count(*) from lines where kind = 'reject') as n_rejects
from lines group by kind, line""",
    "tfidf_round_trip": f"select {_NAMED}, class_id, word, weight from ({_TFIDF_ROWS})",
    "bayes_counts_round_trip": _TRAIN_COUNTS,
    "predictions_round_trip": f"select {_NAMED}, label, prediction from ({_UNDERFLOW})",
    "whole_file_scan": f"""with {_MAIL}
select role || '/' || conv_id || '-' || turn as doc_id, role as class_name, text from mail""",
    "two_path_scan": f"""with lines as (
    select unnest({_LINES}) as value from (select text from benchmark union all select text from conversations))
select value, count(*) as n from lines group by value""",
    "clean_file_scan": f"""with {_MAIL},
msg as (select conv_id || '-a-' || turn as doc_id, turn::varchar as class_name, text from mail),
{_tokens('tok', 'msg')}
select doc_id, split_part(doc_id, '-', 1) || '-a' as document, class_name::int as class_id, word, count(*) as n
from tok group by all""",
    "overwrite_round_trip": _CLASS_MAP,
    "lenient_sparse_read": f"with {_VECTOR_ROWS} select label, features from vectors",
    "libsvm_round_trip": f"""with {_VECTOR_ROWS}
select label, count(*) as n, sum(n)::bigint as n_weights, round(sum(weight_sum), 6) as weight_sum
from (select label, weight_sum, n_features - (select count(*) from tfidf z where z.doc_id = vectors.doc_id and z.weight = 0) as n
      from vectors) group by label""",
    "model_round_trip": f"{_PREDICT_SOURCE} select doc_id, label, prediction from predictions",
}
