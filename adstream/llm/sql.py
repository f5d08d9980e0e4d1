"""The same answers in SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

from adstream.llm import decontamination, secret_scan

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

WARC = f"""
with d as (select page_id, octet_length(encode(coalesce(html, ''))) n, sha1(coalesce(html, '')) h
           from pages),
t as (select *, min(page_id) over (partition by h, n) f from d)
select page_id, cast(n as bigint) payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}',
    1 + cast(((cast('0x' || substr(h, 1 + 10 * (i // 8), 10) as ubigint))
      >> (35 - 5 * (i % 8))) & 31 as int), 1)), '') payload_digest,
  case when page_id = f then 'response' else 'revisit' end record_type,
  case when page_id = f then null else f end refers_to from t"""

NGRAM = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') a from documents),
s as (select distinct doc_id, unnest(case when len(a) >= 4
    then list_transform(range(1, len(a) - 2), lambda i: array_to_string(a[i:i + 3], ' '))
    when len(a) > 0 then [array_to_string(a, ' ')] else [] end) g from w),
n as (select doc_id, count(*) n from s group by 1),
p as (select x.doc_id a, y.doc_id b, count(*) c from s x join s y on x.g = y.g and x.doc_id < y.doc_id
      group by 1, 2),
l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b
      where 100 * c >= 85 * (na.n + nb.n - c)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id a, doc_id b from w union select r.a, e.b from r join e on r.b = e.a)
select w.doc_id, coalesce(n.n, 0) n_shingles, m.c component_id from w left join n using (doc_id)
join (select a, min(b) c from r group by 1) m on m.a = w.doc_id"""

# Unlike the seeds: windows with at most 2 of 13 tokens substituted have a run of 4
# equal tokens, so those runs give the alignments, and equal tokens are counted there.
LEAKS = rf"""
with k as (select cast(doc_id as bigint) id, text, false item from documents
           union all select item_id, text, true from benchmark),
t as (select id, item, list_filter(string_split_regex(lower(text), '[\x00-\x1f\x20-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+'),
      lambda x: x <> '') a from k),
u as (select id, item, len(a) n, unnest(a) w, unnest(range(len(a))) p from t),
r as (select id, item, n, p, w || ' ' || lead(w) over o || ' ' || lead(w, 2) over o || ' '
        || lead(w, 3) over o g from u window o as (partition by id, item order by p)),
c as (select distinct x.id doc_id, y.id item_id, x.p - y.p shift from r x join r y
      on x.g = y.g and not x.item and y.item and x.n >= 8 and y.n >= 13),
m as (select c.*, i.p, d.w = i.w same from c join u i on i.item and i.id = c.item_id
      join u d on not d.item and d.id = c.doc_id and d.p = i.p + c.shift),
z as (select *, sum(cast(same as int)) over o s, count(*) over o q from m
      window o as (partition by doc_id, item_id, shift order by p rows between 12 preceding and current row))
select doc_id, item_id, cast(min(p - 12 + shift) as bigint) first_token,
  cast(max(p + shift) as bigint) last_token, cast(max(s) as bigint) equal_tokens
from z where q = 13 and s >= {decontamination.WINDOW - 2} group by 1, 2"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans(kind: str) -> str:
    """Matches of a kind with their places; a match begins after the gaps and matches before."""
    pattern, group, least = secret_scan.KINDS[kind]
    p = _quoted(pattern)
    return f"""select doc_id, '{kind}' kind, {list(secret_scan.KINDS).index(kind)} rank,
      m, g, unnest(range(1, len(m) + 1)) k, unnest(m) hit, unnest(g) part,
      unnest(list_slice(gaps, 1, len(m))) gap, {least} least from (select doc_id,
        regexp_extract_all(text, {p}, 0) m, regexp_extract_all(text, {p}, {group}) g,
        string_split_regex(text, {p}) gaps from d) where len(m) > 0"""


SECRETS = f"""
with d as (select doc_id, coalesce(text, '') text from documents),
a as ({" union all ".join(f"select * exclude (m, g) from ({_spans(k)})" for k in secret_scan.KINDS)}),
b as (select *, sum(length(gap) + length(hit)) over (partition by doc_id, kind order by k) e from a),
f as (select doc_id, kind, rank, cast(e - length(hit) as bigint) s, cast(e as bigint) e from b
      where length(part) >= least),
h as (select *, count(*) filter (kind = 'break') over (partition by doc_id order by s, e
        rows unbounded preceding) scope, max(e) filter (kind in ('assign', 'access', 'hex'))
        over (partition by doc_id order by s range unbounded preceding) cover from f),
i as (select * from h where kind <> 'break' and (kind <> 'value' or cover is null or cover < e)),
j as (select *, count(*) filter (kind in ('identifier', 'access')) over w who,
        count(*) filter (kind in ('assign', 'value')) over w secret,
        count(*) filter (kind = 'endpoint') over w place from i
      window w as (partition by doc_id, scope order by s range between 200 preceding and 200 following)),
q as (select *, kind in ('assign', 'access', 'hex') base, case kind when 'value' then who > 0 or place > 0
        when 'identifier' then secret > 0 when 'endpoint' then who > 0 and secret > 0 else true end told from j),
o as (select doc_id, count(*) filter (kind = 'assign') n_assign, count(*) filter (kind = 'access') n_access,
        count(*) filter (kind = 'hex') n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (base) base,
        string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (told) spans from q group by 1)
select d.doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex,
  sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans from d left join o using (doc_id)"""

SEGMENTS = r"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line,
             unnest(range(len(string_split(coalesce(text, ''), chr(10))))) k from documents),
b as (select *, coalesce(sum(length(line) + 1) over (partition by doc_id order by k
        rows between unbounded preceding and 1 preceding), 0) base from l),
m as (select doc_id, k, base, regexp_extract_all(line, '[^\x20\x09-\x0D]+') w,
        string_split_regex(line, '[^\x20\x09-\x0D]+') g from b),
x as (select doc_id, k, base, unnest(w) o, unnest(list_slice(g, 1, len(w))) g, unnest(range(len(w))) p
      from m where len(w) > 0),
y as (select *, translate(o, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') w,
        sum(length(g) + length(o)) over (partition by doc_id, k order by p) + base e,
        coalesce(lag(o) over (partition by doc_id, k order by p), '.') before from x),
v as (select w, 37 * list_sum(list_transform(string_split(w, ''), lambda c: unicode(c) % 64)) % 101 v
      from (select distinct w from y)),
z as (select y.*, v, sum(cast(right(before, 1) in ('.', '!', '?') as int)) over
        (partition by doc_id order by k, p) sentence from y join v using (w)),
k as (select *, count(*) over (partition by doc_id, sentence) long from z),
j0 as (select *, sum(cast(right(before, 1) in ('.', '!', '?') and (p = 0 or lag_long >= 4) as int)) over
        (partition by doc_id order by k, p) whole from (select *, lag(long) over (partition by doc_id, k order by p) lag_long from k)),
c as (select *, right(before, 1) in ('.', '!', '?') and (p = 0 or lag_long >= 4)
        or count(*) over (partition by doc_id, whole) > 24
        and coalesce(v < min(v) over (partition by doc_id, k order by p rows between 4 preceding and 1 preceding), true)
        and coalesce(v <= min(v) over (partition by doc_id, k order by p rows between 1 following and 4 following), true)
        begins from j0),
d as (select *, sum(cast(begins as int)) over (partition by doc_id order by k, p) unit from c),
u as (select doc_id, unit, any_value(k) k, min(e - length(o)) s, max(e) e, count(*) words, list(w order by p) a,
        list(e - length(o) order by p) starts, list(e order by p) ends from d group by 1, 2),
f as (select *, first_value(doc_id) over t fd, first_value(s) over t fs, first_value(unit) over t fu from u
      window t as (partition by a order by doc_id, unit)),
h as (select doc_id, k, list(w order by p) a from d group by 1, 2 having count(*) >= 12),
q as (select doc_id, k from h qualify row_number() over (partition by a order by doc_id, k) > 1),
r as (select f.*, q.k is not null whole, unit - row_number() over (partition by f.doc_id order by unit) island
      from f left join q using (doc_id, k) where (f.doc_id, unit) <> (fd, fu)),
t as (select *, words >= 4 counts, row_number() over (partition by doc_id, island order by words desc, unit) longest from r),
i as (select doc_id, island, min(unit) u0, max(unit) u1, min(s) s, max(e) e, sum(words) words, count(*) units,
        coalesce(sum(words) filter (counts), 0) counted, arg_min(fd, unit) kd, arg_min(fs, unit) ks,
        any_value(fd) filter (longest = 1) ad, any_value(fu - unit) filter (longest = 1) moved from t group by 1, 2),
n as (select i.*, b.starts, g.ends,
        coalesce(list_max(list_filter(range(1, least(len(b.a), len(kb.a)) + 1),
          lambda n: b.a[len(b.a) - n + 1:] = kb.a[len(kb.a) - n + 1:])), 0) nb,
        coalesce(list_max(list_filter(range(1, least(len(g.a), len(kg.a)) + 1), lambda n: g.a[1:n] = kg.a[1:n])), 0) ng
      from i left join u b on b.doc_id = i.doc_id and b.unit = u0 - 1
      left join u g on g.doc_id = i.doc_id and g.unit = u1 + 1
      left join u kb on kb.doc_id = ad and kb.unit = u0 - 1 + moved
      left join u kg on kg.doc_id = ad and kg.unit = u1 + 1 + moved),
j as (select doc_id, island, case when nb > 0 then starts[len(starts) - nb + 1] else s end s,
        case when ng > 0 then ends[ng] else e end e, words + nb + ng words, units, kd, ks from n where counted + nb + ng >= 25),
o as (select *, unit - row_number() over (partition by doc_id, island order by unit) part from t
      where whole and (doc_id, island) not in (select (doc_id, island) from j)),
a as (select doc_id, s, e, words, units, kd, ks from j union all
      select doc_id, min(s), max(e), sum(words), count(*), arg_min(fd, unit), arg_min(fs, unit) from o group by doc_id, island, part)
select doc_id, cast(s as bigint) as "start", cast(e as bigint) as "end", cast(words as bigint) words, units,
  kd kept_doc_id, cast(ks as bigint) kept_start from a"""

_LICENCE_TEXTS = """
  ('apache-2.0', 'SPDX-License-Identifier: Apache-2.0'),
  ('apache-2.0', 'Apache License Version 2.0, January 2004'),
  ('apache-2.0', 'Licensed under the Apache License, Version 2.0.'),
  ('apache-2.0', 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
    the License.'),
  ('mit', 'SPDX-License-Identifier: MIT'),
  ('mit', 'MIT License'),
  ('mit', 'Released under the MIT License.'),
  ('mit', 'Licensed under the MIT License.'),
  ('mit', 'The MIT License (MIT)'),
  ('mit', 'MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
    associated documentation files (the "Software"), to deal in the Software without restriction, including without
    limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
    Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The
    above copyright notice and this permission notice shall be included in all copies or substantial portions of the
    Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
    LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
    THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
    CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
    THE SOFTWARE.'),
  ('gpl-3.0', 'SPDX-License-Identifier: GPL-3.0-or-later'),
  ('gpl-3.0', 'SPDX-License-Identifier: GPL-3.0-only'),
  ('gpl-3.0', 'GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007'),
  ('gpl-3.0', 'This work is licensed under the GNU General Public License, version 3.'),
  ('gpl-3.0', 'under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of
    the License, or (at your option) any later version.'),
  ('gpl-2.0', 'SPDX-License-Identifier: GPL-2.0-or-later'),
  ('gpl-2.0', 'SPDX-License-Identifier: GPL-2.0-only'),
  ('gpl-2.0', 'GNU GENERAL PUBLIC LICENSE Version 2, June 1991'),
  ('gpl-2.0', 'This work is licensed under the GNU General Public License, version 2.'),
  ('gpl-2.0', 'under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of
    the License, or (at your option) any later version.'),
  ('lgpl-3.0', 'SPDX-License-Identifier: LGPL-3.0-or-later'),
  ('lgpl-3.0', 'SPDX-License-Identifier: LGPL-3.0-only'),
  ('lgpl-3.0', 'GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007'),
  ('lgpl-3.0', 'Licensed under the GNU Lesser General Public License, version 3.'),
  ('bsd-3-clause', 'SPDX-License-Identifier: BSD-3-Clause'),
  ('bsd-3-clause', 'BSD 3-Clause License'),
  ('bsd-3-clause', 'Licensed under the BSD 3-Clause License.'),
  ('bsd-3-clause', 'Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.'),
  ('bsd-3-clause', 'BSD 3-Clause License All rights reserved. Redistribution and use in source and binary forms, with or without
    modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must
    retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary
    form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
    documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor
    the names of its contributors may be used to endorse or promote products derived from this software without specific
    prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
    OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
    PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
    INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
    SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
    THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
    WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
  ('mpl-2.0', 'SPDX-License-Identifier: MPL-2.0'),
  ('mpl-2.0', 'Mozilla Public License Version 2.0'),
  ('mpl-2.0', 'Subject to the terms of the Mozilla Public License, version 2.0.'),
  ('mpl-2.0', 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.'),
  ('cc-by-4.0', 'SPDX-License-Identifier: CC-BY-4.0'),
  ('cc-by-4.0', 'Creative Commons Attribution 4.0 International'),
  ('cc-by-4.0', 'Licensed under CC BY 4.0.'),
  ('cc-by-4.0', 'This work is licensed under a Creative Commons Attribution 4.0 International License.'),
  ('cc-by-nc-4.0', 'SPDX-License-Identifier: CC-BY-NC-4.0'),
  ('cc-by-nc-4.0', 'Creative Commons Attribution-NonCommercial 4.0 International'),
  ('cc-by-nc-4.0', 'Licensed under CC BY-NC 4.0.'),
  ('cc-by-nc-4.0', 'This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.'),
  ('cc-by-sa-4.0', 'SPDX-License-Identifier: CC-BY-SA-4.0'),
  ('cc-by-sa-4.0', 'Creative Commons Attribution-ShareAlike 4.0 International'),
  ('cc-by-sa-4.0', 'Licensed under CC BY-SA 4.0.'),
  ('cc-by-sa-4.0', 'This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.'),
  ('proprietary', 'All rights reserved.'),
  ('proprietary', 'Copyright. All rights reserved.'),
  ('proprietary', 'Copyright. All rights reserved. Unauthorized copying is prohibited.'),
  ('proprietary', 'Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.')"""

_LICENCE_WORD = "regexp_extract_all(lower(p), '[a-z0-9]+(?:[.][0-9]+)*')"
_SPEAKS = """regexp_matches(line, 'licen[cs]e|copyright|redistribution|all rights reserved|permission is hereby granted|'
    || 'creative commons|unauthori[sz]ed copying', 'i')"""

LICENCES = rf"""
with t as (select *, row_number() over () n from (values {_LICENCE_TEXTS}) x(licence, p)),
d as (select concat_ws('/', source, lang, coalesce(cast(doc_id as varchar), '')) path, coalesce(text, '') text
      from documents),
l as (select path, text, unnest(string_split(text, chr(10))) line,
        unnest(range(len(string_split(text, chr(10))))) k from d),
h as (select *, {_SPEAKS} tells, trim(line, ' ') = '' blank, lead(line) over w after,
        lead({_SPEAKS}) over w tells_after, lead(trim(line, ' ') = '') over w blank_after from l window w as (partition by path order by k)),
r as (select path, k, line, k - row_number() over (partition by path order by k) run from h where tells),
m as (select path, cast(-1 as bigint) k, trim(text, ' ') p from d where path in (select path from r)
      union all select path, k, trim(line, ' ') from r
      union all select path, k, trim(line || ' ' || after, ' ') from h where (tells or tells_after) and not blank and not blank_after
      union all select path, min(k), trim(string_agg(line, ' ' order by k), ' ') from r group by path, run having count(*) > 2),
c as (select p, count(*) times from m group by 1),
lw as (select p, times, unnest({_LICENCE_WORD}) w from c),
lt as (select p, times, w, count(*) tf from lw group by 1, 2, 3),
tw as (select licence, n, unnest({_LICENCE_WORD}) w from t),
tt as (select licence, n, w, count(*) tf from tw group by 1, 2, 3),
z as (select (select count(*) from m) + (select count(*) from t) z),
i as (select w, ln((z + 1) / (sum(times) + 1)) + 1 idf from (select w, times from lt
      union all select w, 1 from tt), z group by w, z),
lv as (select p, w, tf * idf x from lt join i using (w)),
tv as (select licence, n, w, tf * idf y from tt join i using (w)),
s as (select p, licence, round(sum(x * y) / (any_value(xn) * any_value(yn)), 6) cosine from lv join tv using (w)
      join (select p, sqrt(sum(x * x)) xn from lv group by 1) using (p)
      join (select n, sqrt(sum(y * y)) yn from tv group by 1) using (n) group by p, licence, n),
b as (select p, licence, max(cosine) cosine from s group by 1, 2 having max(cosine) >= 0.7),
o as (select path, licence, cosine, k, licence in (select x.licence from b x join m y using (p)
        where y.path = m.path and y.k = -1) gives
      from m join b using (p) qualify row_number() over (partition by path
        order by licence = 'proprietary', cosine desc, k, licence) = 1),
f as (select d.path, regexp_replace(d.path, '/?[^/]*$', '') dir, licence, cosine, gives from d left join o using (path)),
g as (select dir, path, licence, cosine from f where gives
      qualify row_number() over (partition by dir order by licence = 'proprietary', cosine desc, path, licence) = 1),
a as (select f.path, g.licence, g.cosine, g.path giver from f join g
        on f.dir = g.dir or starts_with(f.dir, g.dir || '/') or g.dir = ''
      where f.licence is null qualify row_number() over (partition by f.path order by length(g.dir) desc) = 1)
select f.path, coalesce(f.licence, a.licence) licence, coalesce(f.cosine, a.cosine) cosine,
  case when f.licence is not null then 'own' when a.path is not null then 'inherited' else 'none' end origin,
  case when f.licence is not null then f.path else a.giver end licence_path from f left join a using (path)"""

VECTORS = """
with recursive v as (select vec_id, cast(embedding as double[]) e from embeddings),
u as (select vec_id, e, sqrt(list_dot_product(e, e)) n from v),
l as (select x.vec_id a, y.vec_id b from u x join u y on x.vec_id <> y.vec_id
      and list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.95),
r as (select vec_id a, vec_id b from v union select r.a, l.b from r join l on r.b = l.a)
select v.vec_id, coalesce(d.n, 0) n_links, m.c component_id, v.vec_id = m.c kept from v
left join (select a, count(*) n from l group by 1) d on d.a = v.vec_id
join (select a, min(b) c from r group by 1) m on m.a = v.vec_id"""

DIVERGENCE = r"""
with d as (select coalesce(lang, '') lang, coalesce(source, '') source, row_number() over () id,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') text from documents),
w as (select lang, source, id, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) t from d),
k as (select lang, t, count(*) total from w group by 1, 2 having count(distinct id) >= 3),
v as (select lang, count(*) v, sum(total) n from k group by 1),
g as (select distinct lang, source from d),
c as (select lang, source, t, count(*) c from w semi join k using (lang, t) group by 1, 2, 3),
s as (select lang, source, coalesce(sum(c), 0) n from g left join c using (lang, source) group by 1, 2),
p as (select lang, source, t, coalesce(c, 0) c,
        1 + 1000000000::hugeint * (coalesce(c, 0) + 1) // (s.n + v.v)::hugeint p,
        1 + 1000000000::hugeint * (k.total + 1) // (v.n + v.v)::hugeint q
      from s join v using (lang) join k using (lang) left join c using (lang, source, t)),
b as (select x.lang, x.source, y.source item, sum((x.p - y.p) * (x.p - y.p) // y.p) f
      from p x join p y on x.lang = y.lang and x.t = y.t and x.source <> y.source group by 1, 2, 3),
a as (select x.lang, x.source, 'pair' part, y.source item, coalesce(f, 0) f
      from g x join g y on x.lang = y.lang and x.source <> y.source
      left join b on b.lang = x.lang and b.source = x.source and b.item = y.source
      union all select lang, source, 'term', t, (p - q) * (p - q) // q from p where c > 0 and p > q)
select lang, source, part, item, cast(f as bigint) "value", cast(row_number() over o as int) "rank" from a
window o as (partition by lang, source, part order by f desc, item)
qualify part = 'pair' or row_number() over o <= 200"""

ORACLES = {
    "op1_warc_bundles": WARC,
    "op2_decontamination": LEAKS,
    "op3_secret_scan": SECRETS,
    "op5_segment_dedup": SEGMENTS,
    "op6_ngram_jaccard": NGRAM,
    "op9_licences": LICENCES,
    "op10_multi_index": VECTORS,
    "op12_source_divergence": DIVERGENCE,
}
