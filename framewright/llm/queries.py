"""The training-data queries by name, and DuckDB SQL for those that SQL can express."""

from .bpe import op6_byte_bpe
from .codebooks import OP11_SQL, op11_product_codes
from .hmm import op7_hmm
from .jaccard import op2_jaccard
from .mixing import OP5_SQL, op5_mixing
from .mpegts import op4_transport_stream
from .phrases import OP12_SQL, op12_collocations
from .pii import op10_pii
from .quality import op9_quality
from .simhash import op13_simhash
from .substrings import op3_substrings
from .tokenbin import op1_token_file
from .wrappers import op8_html

QUERIES = {
    "op1_token_file": op1_token_file,
    "op2_jaccard": op2_jaccard,
    "op3_substrings": op3_substrings,
    "op4_transport_stream": op4_transport_stream,
    "op5_mixing": op5_mixing,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_hmm": op7_hmm,
    "op8_html": op8_html,
    "op9_quality": op9_quality,
    "op10_pii": op10_pii,
    "op11_product_codes": op11_product_codes,
    "op12_collocations": op12_collocations,
    "op13_simhash": op13_simhash,
}

OP2_SQL = r"""
with recursive words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingles as materialized (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from words where len(w) > 0)),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as k from shingles a join shingles b using (g) where a.doc_id < b.doc_id group by all),
links as materialized (select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * k >= 85 * (a.n + b.n - k)),
both_ways as materialized (select x, y from links union all select y, x from links),
reached as (select doc_id as a, doc_id as b from documents union select a, y from reached join both_ways on x = b)
select a as doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(b) as component_id from reached left join sizes on doc_id = a group by a
"""

OP3_SQL = r"""
with words as materialized (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from words where len(w) >= 50)),
found as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by h) as first from windows) where first < doc_id),
placed as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from words),
marked as (
  select p.doc_id, p.i, p.word, max(f.i) over (partition by p.doc_id order by p.i rows unbounded preceding) as last
  from placed p left join found f on f.doc_id = p.doc_id and f.i = p.i),
kept as (
  select doc_id, count(*) as n_words, count(*) filter (where i - last < 50) as n_removed, string_agg(word, ' ' order by i) filter (where last is null or i - last >= 50) as text
  from marked group by doc_id)
select d.doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(k.text, '')) as kept_sha256 from documents d left join kept k using (doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op2_jaccard": OP2_SQL, "op3_substrings": OP3_SQL, "op5_mixing": OP5_SQL, "op11_product_codes": OP11_SQL, "op12_collocations": OP12_SQL}
