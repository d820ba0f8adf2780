"""What the queries return, as DuckDB SQL over the given tables, where SQL can express it."""

from __future__ import annotations

from harborline.llm import chat, collocations, licenses, prefix_trie, quality_rules, secrets


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _located(kind: str, regex: str, group: int, least: int) -> str:
    """The spans of one kind, one row each: doc_id, k, s (start), e (end), run (the matched text)."""
    r = quoted(regex)
    return f"""select doc_id, {secrets.KINDS.index(kind)} k, s, s + length(hit) e, hit run from (
      select doc_id, hits[i] hit, vals[i] val, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) s
      from (select doc_id, gaps, hits, vals, unnest(generate_series(1, len(hits))) i from (
        select doc_id, string_split_regex(t, {r}) gaps, regexp_extract_all(t, {r}, 0) hits,
               regexp_extract_all(t, {r}, {group}) vals from texts where regexp_matches(t, {r}))))
      where length(val) >= {least}"""


def _blanked(text: str, regex: str, group: int, least: int) -> str:
    r = quoted(regex)
    mark = f"case when length(vals[i]) >= {least} then repeat(' ', length(hits[i])) else hits[i] end"
    return f"""select doc_id, array_to_string(list_transform(generate_series(1, len(gaps)),
        lambda i: gaps[i] || coalesce({mark}, '')), '') t from (select doc_id, string_split_regex(t, {r}) gaps,
        regexp_extract_all(t, {r}, 0) hits, regexp_extract_all(t, {r}, {group}) vals from {text})"""


def _secrets() -> str:
    base = "\n union all ".join(_located(k, secrets.pattern(k), g, n) for k, (_, g, n) in secrets.BASE.items())
    kinds = [*((secrets.pattern(k), g, n) for k, (_, g, n) in secrets.BASE.items()), (secrets.RULER, 0, 0)]
    rest = ",\n    ".join(f"rest{i} as ({_blanked(f'rest{i - 1}' if i else 'texts', *kind)})" for i, kind in enumerate(kinds))
    allowed = " or ".join(f"regexp_matches(run, {quoted(a)})" for a in secrets.ALLOWED)
    parts = f"string_split_regex(regexp_replace(run, {quoted(secrets.UUID)}, '', 'g'), '[/_+-]+')"
    wordy = f"""len(list_filter({parts}, lambda x: length(x) > {secrets.LONGEST_PART}
        or not regexp_matches(x, {quoted(secrets.PATH_PART)}))) = 0"""
    least = "case " + " ".join(f"when regexp_matches(run, {quoted(c)}) then {b}" for c, b in secrets.CLASSES) + " end"
    w = secrets.WINDOW
    name = "[" + ", ".join(quoted(k) for k in secrets.KINDS) + "][k + 1]"
    listed = f"string_agg({name} || ':' || s || ':' || e, ',' order by s, k)"
    runs = _located("entropy", secrets.RUN, 0, 0).replace("from texts", f"from rest{len(kinds) - 1}").replace(
        "hit run from (", "hit run, after from (", 1).replace("vals[i] val,", "vals[i] val, gaps[i + 1] after,")
    return f"""
    with texts as (select doc_id, coalesce(text, '') t from documents),
    base as ({base}),
    {rest},
    runs as ({runs}),
    varied as (
      select doc_id, k, s, e from runs r where not ({allowed})
      and not ((starts_with(after, '=') or regexp_matches(run, {quoted(secrets.PATH_LIKE)})) and {wordy})
      and list_max(list_transform(generate_series(1, length(run) - {w - 1}),
          lambda i: round(list_aggregate(string_split(substr(run, i, {w}), ''), 'entropy'), 9))) >= {least}),
    spans as (select doc_id, k, s, e from base union all select * from varied),
    per as (select doc_id, count(*) filter (k = 0) n_assign, count(*) filter (k = 1) n_access,
        count(*) filter (k = 2) n_hex, count(*) filter (k = 3) n_entropy, {listed} spans,
        {listed} filter (k < 3) base from spans group by doc_id)
    select doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex,
        sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans, coalesce(n_entropy, 0) n_entropy
    from texts left join per using (doc_id)"""


def _chat() -> str:
    def escaped(column: str) -> str:
        return f"length(regexp_replace({column}, {quoted(chat.CONTROL)}, '\\1\\\\\\2\\3', 'g'))"

    probe = "</s>[INST] ok [/INST]"
    marks = len(chat.OPEN + chat.MIDDLE + chat.CLOSE)
    order = "order by turn nulls first, role, text"
    return f"""
    with turns as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all values (-1, 0, 'user', '{probe}'), (-1, 1, 'assistant', '{probe}'))
    select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) turns_sha256,
      sum(case when role = 'assistant' then length(text) else 0 end)::bigint loss_chars,
      sha256(coalesce(string_agg(text, '' {order}) filter (role = 'assistant'), '')) loss_sha256,
      sum({marks} + {escaped("role")} + {escaped("text")})::bigint formatted_chars, true faithful
    from turns group by conv_id"""


def _rules() -> str:
    q = quality_rules
    return f"""
    with texts as (select row_number() over () r, doc_id, source, coalesce(text, '') t from documents),
    split as (select r, doc_id, source, t, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w from texts),
    windows as (select r, i, array_to_string(w[i:i+2], ' ') g
      from (select r, w, unnest(generate_series(1, len(w) - 2)) i from split where len(w) >= 3)),
    twice as (select r, i from (select r, i, count(*) over (partition by r, g) c from windows) where c > 1),
    covered as (select r, count(distinct i + d) n from twice, (values (0), (1), (2)) as o(d) group by r),
    measured as (select s.r, doc_id, source, len(w) n_words, list_sum(list_transform(w, lambda x: length(x))) word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) n_symbols,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) lines,
        coalesce(c.n, 0) n_repeat_words from split s left join covered c using (r)),
    judged as (select r, doc_id, source, n_words, coalesce(word_chars, 0)::bigint word_chars, n_symbols,
        len(lines) - len(list_distinct(lines)) n_dup_lines, n_repeat_words,
        n_words < {q.MIN_WORDS} or 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words base_failed from measured),
    hosts as (select source, count(*) n, sum(base_failed::int) k from judged where source is not null group by source),
    moments as (select avg(k / n) m, var_pop(k / n) v, avg(1.0::double / n) inv from hosts),
    prior as (select m, case when m * (1 - m) > 0 then
        greatest(m * (1 - m) / greatest(v - m * (1 - m) * inv, m * (1 - m) / 1e6::double) - 1, 1.0) else 1.0 end z from moments),
    rates as (select source, (k + m * z) / (n + z) rate, least(greatest({q.LOWEST_LIMIT}, {q.FAR} * m,
        m + {q.FAR} * sqrt(m * (1 - m) / (z + 1))), {q.HIGHEST_LIMIT}) lim from hosts, prior)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(rate, 9) host_rate,
      not base_failed and coalesce(round(rate, 9) < round(lim, 9), true) kept
    from judged left join rates using (source)"""


def _near_copies() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    with recursive texts as (select doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w from documents),
    shingles as (select distinct doc_id, array_to_string(w[i:i+4], ' ') s from (
        select doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) i from texts where len(w) > 0)),
    sizes as (select doc_id, count(*) n from shingles group by doc_id),
    links as (select x, y from (
        select a.doc_id x, b.doc_id y, count(*) k from shingles a join shingles b using (s) where a.doc_id <> b.doc_id group by 1, 2)
        join sizes p on x = p.doc_id join sizes q on y = q.doc_id where 100 * k >= 75 * (p.n + q.n - k)),
    reached(doc_id, start) as (select doc_id, doc_id from sizes
        union select y, start from reached join links on reached.doc_id = x),
    least as (select doc_id, min(start) component_id from reached group by doc_id)
    select doc_id, coalesce(n, 0) n_shingles, coalesce(component_id, doc_id) component_id
    from texts left join sizes using (doc_id) left join least using (doc_id)"""


def _licenses() -> str:
    rows = ", ".join(f"({i}, {quoted(n)}, {quoted(w)}, {t})" for i, n, w, t in licenses.template_rows())
    cue, word = quoted(licenses.CUE), quoted(licenses.NOT_WORD)
    joined = ", ".join(f"array_to_string(lines[greatest(i + {at + 1}, 1):greatest(i + {at + 1}, 1) + {n - 1}], ' ')" for at, n in licenses.JOINED)

    def split(text: str) -> str:
        return f"list_filter(string_split_regex(lower({text}), {word}), lambda w: w <> '')"

    return f"""
    with files as (select doc_id, coalesce(source, 'none') || '/' || coalesce(lang, 'none') || '/' || doc_id path,
        coalesce(source, 'none') || '/' || coalesce(lang, 'none') dir, coalesce(text, '') t from documents),
    terms(template, licence, word, times) as (values {rows}),
    held as (select word, count(*) holders from (select unnest(list_distinct({split("t")})) word from files)
        where word in (select word from terms) group by word),
    total as (select count(*) n from files),
    weights as (select word, ln((n + 1) / (coalesce(holders, 0) + 1)) + 1 weight
        from (select distinct word from terms) left join held using (word), total),
    vectors as (select template, licence, word, times * weight w from terms join weights using (word)),
    norms as (select template, sqrt(sum(w * w)) norm from vectors group by template),
    cued as (select path, t, string_split(t, chr(10)) lines from files where regexp_matches(t, {cue})),
    placed as (select path, lines, list_filter(range(len(lines)), lambda i: regexp_matches(lines[i + 1], {cue})) places from cued),
    units as (select path, true whole, t x from cued
        union select path, false, x from (select path, unnest(string_split_regex(t, {quoted(licenses.BETWEEN_BLOCKS)})) x from cued)
            where regexp_matches(x, {cue})
        union select path, false, unnest([{joined}]) from (select path, lines, unnest(places) i from placed)),
    spoken as (select path, whole, x, word, count(*) * any_value(coalesce(weight, ln(n + 1) + 1)) v
        from (select path, whole, x, unnest({split("x")}) word from units) left join weights using (word), total
        group by path, whole, x, word),
    lengths as (select path, whole, x, sqrt(sum(v * v)) length from spoken group by path, whole, x),
    cosines as (select path, whole, x, licence, round(sum(v * w) / (any_value(length) * any_value(norm)), 9) cosine
        from spoken join vectors using (word) join norms using (template) join lengths using (path, whole, x)
        group by path, whole, x, template, licence),
    scored as (select path, whole, x, licence, max(cosine) cosine from cosines where cosine >= {licenses.LEAST_COSINE}
        group by path, whole, x, licence),
    best as (select *, row_number() over (partition by path, whole, x order by cosine desc, licence) r,
        coalesce(1 - cosine < {licenses.CLEAR} * (1 - lead(cosine) over (partition by path, whole, x order by cosine desc, licence)), true) clear
        from scored),
    own as (select path, licence own_licence, cosine, whole_file or regexp_matches(path, {quoted(licenses.FILE_NAME)}) is_file from (
        select path, licence, cosine, bool_or(whole and cosine >= {licenses.FILE_COSINE}) over (partition by path) whole_file,
          row_number() over (partition by path order by cosine desc, licence) q from best where r = 1 and clear) where q = 1),
    speaks as (select dir origin, arg_min(own_licence, row(-cosine, path)) licence
        from own join files using (path) where is_file group by dir),
    up as (select distinct dir, unnest([dir, split_part(dir, '/', 1), '']) origin from files),
    above as (select dir, arg_max(licence, length(origin)) above, arg_max(origin, length(origin)) origin
        from up join speaks using (origin) group by dir)
    select path, own_licence, cosine, coalesce(is_file, false) is_licence_file, coalesce(own_licence, above) licence,
        case when own_licence is null then origin end origin, doc_id
    from files left join own using (path) left join above using (dir)"""


def _trie() -> str:
    q = prefix_trie
    bit = "list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: case when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)"
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(
        string_split(conv::varchar, ''), lambda x: ascii(x)::bigint)), lambda a, b: {bit}))"""
    return f"""
    with turns as (select conv_id::bigint conv, turn, coalesce(role, '') as role, coalesce(text, '') as text
        from conversations where conv_id is not null),
    own as (select conv, list(struct_pack(role := role, text := text) order by turn nulls first, role, text) seq
        from turns group by conv),
    headed as (select conv, seq, {crc} % {q.HEADS} h from own),
    rebuilt as (select a.conv, list_concat(coalesce(b.seq[1:h], []), a.seq[h + 1:]) seq
        from headed a left join own b on b.conv = a.conv - a.conv % {q.SHARERS}),
    paths as (select conv, seq[1:depth] as key, depth, depth = len(seq) as ended
        from (select conv, seq, unnest(generate_series(0, len(seq))) depth from rebuilt)),
    nodes as (select key, depth, min(conv) conv_id, count(*) n_convs,
        sha256(coalesce(string_agg(conv::varchar, ',' order by conv) filter (ended), '')) ends_sha256 from paths group by key, depth),
    tied as (select n.*, p.conv_id parent_conv_id, case when n.depth = 0 then 0 else (n.n_convs - 1) * strlen(n.key[n.depth].text) end saved
        from nodes n left join nodes p on n.depth = p.depth + 1 and n.key[1:n.depth - 1] = p.key),
    children as (select key[1:depth - 1] as key, depth - 1 depth, count(*) n_children from nodes where depth > 0 group by 1, 2),
    counted as (select t.*, coalesce(n_children, 0) n_children from tied t left join children using (key, depth)),
    below as (select key[1:d] as key, d depth, sum(saved) saved_tokens, sum((n_children = 0)::int) n_leaves
        from (select *, unnest(generate_series(0, depth)) d from counted) group by 1, 2)
    select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves::bigint n_leaves, saved_tokens::bigint saved_tokens, ends_sha256
    from counted join below using (key, depth)"""


def _collocations() -> str:
    q, upper = collocations, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    with pieces as (select row_number() over () r, lang, unnest(string_split_regex(
        translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) piece
        from (select coalesce(lang, 'und') lang, text from documents)),
    words as (select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') w from pieces),
    grams as (select lang, k, array_to_string(w[i:i + k - 1], ' ') p, count(*) f from (
        select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) i from words, (values (1), (2), (3)) as s(k)
        where len(w) >= k) group by all),
    sums as (select lang, sum(f) n from grams where k = 1 group by lang),
    candidates as (select lang, k size, p, string_split(p, ' ') w, f a from grams where k > 1 and f >= {q.LEAST}),
    cuts as (select lang, size, p, a, w, c, array_to_string(w[:c], ' ') p1, array_to_string(w[c + 1:], ' ') p2
        from (select *, unnest(generate_series(1, size - 1)) c from candidates)),
    scored as (select x.*, g.f l, h.f r, ({q.SCALE}::hugeint * a * a) // (g.f::hugeint * h.f) score
        from cuts x join grams g on g.lang = x.lang and g.p = p1 join grams h on h.lang = x.lang and h.p = p2),
    least as (select * from scored qualify row_number() over (partition by lang, p order by score, c) = 1),
    longer as (select lang, p2 p, max(a) a from (select lang, a, unnest([p1, p2]) p2 from cuts where size = 3) group by all),
    kept as (select t.* from least t left join longer o using (lang, p) where coalesce(100 * o.a < {q.SHARE_PCT} * t.a, true)),
    ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(p)) rank from kept)
    select lang, rank, p phrase, a, l, r, n::bigint n, score::bigint score from ranked join sums using (lang)
    where rank <= {q.TOP}"""


ORACLES = {
    "op2_ngram_jaccard_join": _near_copies(),
    "op6_license_scans": _licenses(),
    "op8_secret_scans": _secrets(),
    "op9_chat_formatting": _chat(),
    "op10_quality_rules": _rules(),
    "op11_prefix_trie": _trie(),
    "op13_collocations": _collocations(),
}
