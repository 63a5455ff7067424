"""Surrogates for personal data, with DataFrame functions only.

Entities are found by patterns; each gets a keyed replacement of its kind and shape:
digits stay digits (numbers are permuted by a small keyed Feistel network, so
different numbers of one length never meet), card numbers that pass the
Luhn check still do, address octets keep their digit count, letters keep
their script and case, mail addresses of one domain share a new domain,
titled names keep their title, gender, hyphens and capitals.  A name is known by
its title; from there on each of its words is replaced wherever it stands capitalised in that
document, with or without a title.  Replacements depend on the key, kind and
canonical form alone, so one entity has one surrogate in all documents
and spellings.  All distinct entities are checked: a surrogate that two of them share,
or that is itself an entity of the corpus, is drawn again, and again, growing
in length where its kind allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import materialise

#: Titles by gender (fixed values; matched before a capitalised name).
TITLES = {"m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Господин", "Κύριος"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Госпожа", "Κυρία"),
          "n": ("Dr", "Prof")}
#: One word of a name: capitalised, of two letters or more, an O' before it belongs to it.
WORD = r"(?<!\p{L})(?:\p{Lu}['’](?=\p{Lu}))?\p{Lu}\p{L}++"
INITIAL = r"(?<!\p{L})\p{Lu}(?!['’]?\p{L})"
_DOUBLE = r"(?:\p{Lu}['’](?=\p{Lu}))?\p{Lu}\p{L}++(?:-\p{Lu}\p{L}++){0,3}"
_NAMED = r"(?:\p{Lu}\.? ){0,3}" + _DOUBLE
# in capitals a title needs its dot: MISS and SIR are words of headlines too
NAME = (r"(?<!\p{L})(?:(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.?|(?:MR|MRS|MS|DR|PROF)\.) "
        + _NAMED + "(?: " + _NAMED + ")?")
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# Repeats without a small bound are possessive: Java's matcher else calls itself once for each, and long runs exhaust its stack.
KINDS = [  # order decides where patterns overlap
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++"),
    ("hex", r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\p{L}\p{N}])"),
    ("ip", r"(?<![\d.])" + OCTET + r"(?:\." + OCTET + r"){3}(?!\d|\.\d)"),
    ("iban", r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"),
    ("phone", r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}(?!\d)"
              r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", r"(?<!\d)(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{13,19})(?!\d)"),
    ("name", NAME),
]
ANY = "|".join(p.replace(r"([ -])\d{4}\1\d{4}\1\d{4}", r"(?:(?: \d{4}){3}|(?:-\d{4}){3})") for _, p in KINDS)
#: Syllables of made names by script (fixed values).
SYLLABLES = {"latin": "ba,be,bi,do,du,fa,fe,ga,ka,ke,la,le,li,lo,ma,me,mi,mo,na,ne,ni,no,pa,pe,ra,re,ri,ro,sa,se,ta,te",
             "cyrillic": "ба,бе,да,де,ди,за,ка,ке,ла,ле,ли,ло,ма,ме,ми,мо,на,не,ни,но,па,пе,ра,ре,ри,ро,са,се,та,те,ва,ви",
             "greek": "βα,βε,δα,δε,δι,ζα,κα,κε,λα,λε,λι,λο,μα,με,μι,μο,να,νε,νι,νο,πα,πε,ρα,ρε,ρι,ρο,σα,σε,τα,τε,φα,φι"}
#: Last letters of made first names by script and gender (fixed values).
ENDINGS = {"latin": {"m": "n", "f": "na", "n": "l"}, "cyrillic": {"m": "н", "f": "на", "n": "л"},
           "greek": {"m": "ν", "f": "να", "n": "λ"}}
ALPHABETS = [("abcdefghijklmnopqrstuvwxyz", "[a-z]"), ("абвгдежзиклмнопрстуфхцчшщэюя", "[а-яё]"),
             ("αβγδεζηθικλμνξοπρστυφχψω", "[α-ωά-ώ]"), ("àâäçèéêëîïñóôöùûü", "[ß-öø-ÿ]")]


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(text: str) -> str:
    """SQL: 48 bits of a keyed hash of the SQL string ``text``."""
    return f"cast(conv(substring(sha2(concat(key, {text}), 256), 1, 12), 16, 10) as bigint)"


def _feistel() -> str:
    """SQL over ``kind, body, attempt``: a keyed permutation of the digit string ``body``."""
    a = "(length(body) div 2)"
    ten = lambda n: f"cast(pow(10, {n}) as bigint)"
    left, right = f"cast(substring(body, 1, {a}) as bigint)", f"cast(substring(body, {a} + 1) as bigint)"
    tag = "concat('|', kind, '|', head, '|', length(body), '|', attempt, '|', "
    out = f"named_struct('l', {left}, 'r', {right})"
    for i in range(2):
        out = (f"transform(array({out}), s -> named_struct('l', (s.l + {_number(tag + f'{2 * i}, chr(47), s.r)')}) % {ten(a)}, 'r', s.r))[0]")
        out = (f"transform(array({out}), s -> named_struct('l', s.l, 'r', (s.r + {_number(tag + f'{2 * i + 1}, chr(47), s.l)')}) % {ten(f'(length(body) - {a})')}))[0]")
    return (f"transform(array({out}), s -> concat(lpad(cast(s.l as string), {a}, '0'), "
            f"lpad(cast(s.r as string), length(body) - {a}, '0')))[0]")


def _luhn(digits: str) -> str:
    """SQL: Luhn sum of a digit string modulo 10."""
    return (f"(aggregate(transform(split(reverse({digits}), ''), (c, i) -> if(c = '', 0, if(i % 2 = 0, cast(c as int), "
            "if(cast(c as int) > 4, 2 * cast(c as int) - 9, 2 * cast(c as int))))), 0, (a, x) -> a + x) % 10)")


def _shape(text: str, seed: str, hexadecimal: bool = False) -> str:
    """SQL: ``text`` with every letter and digit redrawn within its class, keyed by the hash of ``seed``."""
    byte = (f"cast(conv(substring(sha2(concat(key, z, '|', cast(i div 16 as string)), 256), "
            "cast(4 * (i % 16) + 1 as int), 4), 16, 10) as int)")
    cases = ["when c rlike '[0-9]' then cast(n % 10 as string)"]
    for letters, cls in [("abcdef", "[a-f]")] if hexadecimal else ALPHABETS:
        cases.append(f"when c rlike '{cls}' then substring('{letters}', n % {len(letters)} + 1, 1)")
    one = f"transform(array({byte}), n -> case {' '.join(cases)} else c end)[0]"
    return f"transform(array(sha2({seed}, 256)), z -> array_join(transform(split({text}, ''), (c, i) -> {one}), ''))[0]"


def _surrogate(key: str) -> Column:
    """Surrogate of (kind, canon, attempt)."""
    seed = "concat('|', kind, '|', canon, '|', cast(attempt as string))"
    number = f"concat(head, {_feistel()}, tail)"
    octet = lambda i: f"cast(element_at(split(canon, '[.]'), {i}) as bigint)"
    ip = f"array({', '.join(octet(i) for i in range(1, 5))})"
    lows = "transform(split(canon, '[.]'), o -> case length(o) when 1 then 0 when 2 then 10 else 100 end)"
    for i in [0, 1, 2, 3] * 2:   # each octet moves within its digit count by a hash of the others
        others = f"array_join(transform(v, (x, j) -> if(j = {i}, '-', cast(x as string))), '.')"
        moved = (f"transform(v, (x, j) -> if(j = {i}, lo[{i}] + (x - lo[{i}] + {_number(f'concat(chr(47), attempt, {others})')}) "
                 f"% case lo[{i}] when 0 then 10 when 10 then 90 else 156 end, x))")
        ip = f"transform(array({ip}), v -> transform(array({lows}), lo -> {moved})[0])[0]"
    ip = f"array_join(transform({ip}, x -> cast(x as string)), '.')"
    domain = "substring_index(canon, '@', -1)"
    host = f"substring({domain}, 1, length({domain}) - length(substring_index({domain}, '.', -1)))"
    email = (f"concat({_shape('''substring_index(canon, '@', 1)''', seed)}, "
             f"if(attempt > 4, substring(sha2({seed}, 256), 1, attempt - 4), ''), '@', "
             + _shape(host, f"concat('|domain|', {domain})") + f", substring_index({domain}, '.', -1))")
    def made(script):
        syl = "array(" + ",".join(f"'{s}'" for s in SYLLABLES[script].split(",")) + ")"
        many = "(2 + (attempt div 2))"
        parts = (f"array_join(transform(sequence(1, {many}), i -> element_at({syl}, "
                 f"cast({_number(f'concat({seed}, cast(i as string))')} % 32 as int) + 1)), '')")
        ends = " ".join(f"when kind = 'first_{g}' then '{e}'" for g, e in ENDINGS[script].items())
        return f"concat({parts}, case {ends} else '' end)"
    name = (f"case when canon rlike '[а-яё]' then {made('cyrillic')} when canon rlike '[α-ωά-ώ]' then {made('greek')} "
            f"else {made('latin')} end")
    sql = (f"case when kind in ('phone', 'card', 'ssn') then {number} when kind = 'ip' then {ip} "
           f"when kind = 'email' then {email} when kind = 'hex' then {_shape('canon', seed, True)} "
           f"when kind = 'iban' then concat(substring(canon, 1, 2), {_shape('substring(canon, 3)', seed)}) else {name} end")
    return F.expr(sql.replace("concat(key,", f"concat({_lit(key)},"))


def _with_surrogates(ents: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt, surrogate).  Numbers keep their first digit, valid cards their check digit's law."""
    luhn = "(kind = 'card' and " + _luhn("canon") + " = 0)"
    ready = (ents.withColumn("valid", F.expr(luhn))
             .withColumn("head", F.when(F.col("kind").isin("phone", "card"), F.substring("canon", 1, 1)).otherwise(""))
             .withColumn("tail", F.lit(""))
             .withColumn("body", F.expr("substring(canon, length(head) + 1, length(canon) - length(head) - if(valid, 1, 0))")))
    out = ready.withColumn("surrogate", _surrogate(key))
    check = "cast((10 - " + _luhn("concat(surrogate, '0')") + ") % 10 as string)"
    return out.withColumn("surrogate", F.expr(f"if(valid, concat(surrogate, {check}), surrogate)")).select(
        "kind", "canon", "attempt", "surrogate")


def assign(ents: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) of distinct entities (kind, canon), checked for collisions."""
    table = materialise(_with_surrogates(ents.withColumn("attempt", F.lit(0)), key), "pii-surrogates")
    while True:
        kept = table.groupBy("kind", "surrogate").agg(F.min("canon").alias("first"))
        real = ents.select("kind", F.col("canon").alias("surrogate"), F.lit(True).alias("real"))
        bad = (table.join(kept, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
               .where((F.col("canon") != F.col("first")) | F.col("real")).select("kind", "canon", "attempt"))
        bad = materialise(bad, "pii-bad")
        if bad.isEmpty():
            return table.select("kind", "canon", "surrogate")
        again = _with_surrogates(bad.withColumn("attempt", F.col("attempt") + 1), key)
        table = materialise(table.join(bad.select("kind", "canon"), ["kind", "canon"], "left_anti").union(again),
                            "pii-surrogates")


def _kind(m: str) -> str:
    out = " ".join(f"when {m} rlike {_lit('^(?:' + p + ')$')} then '{k}'" for k, p in KINDS[:-1])
    return f"case {out} else 'name' end"


def _gender(m: str) -> str:
    out = " ".join(f"when {m} rlike {_lit('(?iu)^(?:' + '|'.join(TITLES[g]) + ')[.]? ')} then '{g}'" for g in ("m", "f"))
    return f"case {out} else 'n' end"


def _parts(m: str) -> str:
    """SQL: the (kind, canon) entities of a mention; a titled name has one for each of its words."""
    words = (f"filter(split(regexp_replace({m}, '^[^ ]+ ', ''), ' '), t -> t rlike {_lit(WORD)})")
    # the first of two words is a first name, the others last names; each side of a hyphen is a word of its own
    name = (f"flatten(transform({words}, (t, i) -> transform(regexp_extract_all(t, {_lit(WORD)}, 0), e -> named_struct("
            f"'kind', if(i = 0 and size({words}) > 1, concat('first_', {_gender(m)}), 'last'), 'canon', lower(e)))))")
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    return (f"transform(array({_kind(m)}), k -> case when k = 'name' then {name} else array(named_struct('kind', k, 'canon', "
            f"case when k in ('phone', 'card', 'ssn') then {digits} when k = 'iban' then replace({m}, ' ', '') else lower({m}) end)) end)[0]")


def _pour(m: str, kind: str, s: str) -> str:
    """SQL: the surrogate in the mention's format: digits in place, capitals where they were."""
    nth = f"length(regexp_replace(substring({m}, 1, i + 1), '[^0-9]', ''))"
    digits = f"array_join(transform(split({m}, ''), (c, i) -> if(c rlike '[0-9]', substring({s}, {nth}, 1), c)), '')"
    spaced = f"array_join(transform(split({m}, ''), (c, i) -> if(c = ' ', c, substring({s}, length(replace(substring({m}, 1, i + 1), ' ', '')), 1))), '')"
    cased = (f"if({m} = upper({m}) and {m} != lower({m}), upper({s}), if({m} = lower({m}), {s}, "
             f"concat(upper(substring({s}, 1, 1)), substring({s}, 2))))")
    return (f"case when {kind} in ('phone', 'card', 'ssn') then {digits} when {kind} = 'iban' then {spaced} else {cased} end")


def _turned(c: str, key: str) -> str:
    """SQL: an initial, moved along its alphabet by a keyed step, so that different initials stay different."""
    out = f"lower({c})"
    for letters, _ in ALPHABETS:
        step = f"(1 + cast(conv(substring(sha2({_lit(key + '|initial')}, 256), 1, 8), 16, 10) as bigint) % {len(letters) - 1})"
        out = f"translate({out}, '{letters}', substring('{letters * 2}', cast(1 + {step} as int), {len(letters)}))"
    return f"upper({out})"


def _rewrite(t: str, key: str | None = None) -> str:
    """SQL: ``t`` with the words of ``_pii_words`` replaced; with a key, initials too (inside a titled name)."""
    pattern = _lit(WORD if key is None else WORD + "|" + INITIAL)
    s = "_pii_words[lower(w)]"
    new = f"if(w = upper(w), upper({s}), concat(upper(substring({s}, 1, 1)), substring({s}, 2)))"
    if key is not None:
        new = f"if(length(w) = 1, {_turned('w', key)}, {new})"
    return (f"array_join(flatten(zip_with(split({t}, {pattern}, -1), regexp_extract_all({t}, {pattern}, 0), "
            f"(u, w) -> array(u, coalesce({new}, w, '')))), '')")


def replace_personal_data(docs: DataFrame, text_col: str = "text", key: str = "surrogate-key-1") -> DataFrame:
    """``docs`` with entities in the text replaced, and ``n_entities`` (mentions found, and words of a
    titled name that stand elsewhere in the document; replaced if there).

    A name without a title anywhere in its document is not found; an initial is replaced
    inside a titled name only.

    Rows keep their number, order of columns and all other columns.  Null texts stay null with 0
    entities, empty texts empty; texts of any length are read whole; repeated texts get
    the same result; an empty table gives no rows.  The result depends on the key and on
    collisions within the table, which are settled in the order of entities.
    """
    kept = [c for c in docs.columns if c != "n_entities"]
    # other columns travel under names of their own: theirs may hold dots or be names used here
    safe = [c if c == text_col else f"_pii_c{i}" for i, c in enumerate(kept)]
    docs = named = docs.select(*[F.col("`" + c.replace("`", "``") + "`").alias(n) for c, n in zip(kept, safe)])
    mentions = F.expr(f"regexp_extract_all({text_col}, {_lit(ANY)}, 0)")
    keys = [F.xxhash64(text_col).alias("_pii_k1"), F.xxhash64(F.col(text_col), F.lit(1)).alias("_pii_k2")]
    found = materialise(docs.select(*keys, F.array_distinct(mentions).alias("ms")).where(F.size("ms") > 0)
                        .groupBy("_pii_k1", "_pii_k2").agg(F.first("ms").alias("ms")), "pii-found")
    each = found.select("_pii_k1", "_pii_k2", F.explode("ms").alias("m")).withColumn("parts", F.expr(_parts("m")))
    ents = materialise(each.select(F.explode("parts").alias("p")).select("p.kind", "p.canon").distinct(), "pii-entities")
    table = assign(ents, key)
    part = each.select("_pii_k1", "_pii_k2", "m", F.explode("parts").alias("p")).select("*", "p.kind", "p.canon").drop("p")
    done = part.join(table, ["kind", "canon"])
    is_name = F.col("kind").isin("last", "first_m", "first_f", "first_n")
    # whole mentions by their text; names word by word, a word that is both first and last name as first name
    poured = F.when(~is_name, F.struct("m", F.expr(_pour("m", "kind", "surrogate")).alias("r")))
    word = F.when(is_name, F.struct("canon", "kind", "surrogate"))
    words = F.sort_array(F.collect_set(word))
    maps = materialise(done.groupBy("_pii_k1", "_pii_k2").agg(
        F.map_from_entries(F.collect_list(poured)).alias("_pii_map"), words.alias("w"))
        .withColumn("w", F.expr("filter(w, (x, i) -> i = 0 or x.canon != w[i - 1].canon)"))
        .select("_pii_k1", "_pii_k2", "_pii_map",
                F.expr("map_from_entries(transform(w, x -> struct(x.canon, x.surrogate)))").alias("_pii_words")), "pii-maps")
    # one join plan at every size: the maps grow with the input
    joined = named.select("*", *keys).join(maps.hint("merge"), ["_pii_k1", "_pii_k2"], "left")
    pieces, mentioned = f"split({text_col}, {_lit(ANY)}, -1)", f"regexp_extract_all({text_col}, {_lit(ANY)}, 0)"
    between = f"if(size(_pii_words) = 0, t, {_rewrite('t')})"
    rebuilt = F.expr(f"if(_pii_map is null, {text_col}, array_join(flatten(zip_with({pieces}, {mentioned}, "
                     f"(t, m) -> array({between}, coalesce(_pii_map[m], {_rewrite('m', key)}, '')))), ''))")
    later = (f"if(size(_pii_words) = 0, 0, aggregate({pieces}, 0, (a, t) -> a + size(filter(regexp_extract_all(t, {_lit(WORD)}, 0), "
             "w -> _pii_words[lower(w)] is not null))))")
    count = F.expr(f"if(_pii_map is null, 0, size({mentioned}) + {later})")
    return joined.withColumn("n_entities", count.cast("int")).withColumn(text_col, rebuilt).select(
        *safe, "n_entities").toDF(*kept, "n_entities")
