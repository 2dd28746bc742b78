"""Variant spellings of names typed by people, linked to the entity they mean.

1. The distinct tokens of typed names and of the catalogue's names and aliases (also the
   joined whole of a name) become sets of q-grams.
2. Prefix-filtered set-similarity join of the two token sets: grams are ordered by
   frequency, rarest first.  ``EDITS`` edits leave two sets of grams with so many in common that
   they must share one within their prefixes, at places and in words whose lengths differ by
   no more than the edits: the join key is gram, place and length, so a common gram does not
   bring all words together.  The edit distance is taken next.  A spelling becomes a candidate
   of a name by its rarest word (where an initial may stand for that, by its second rarest too)
   if its other words are met as well.
3. Candidates are verified by soft weighted token similarity: tokens pair up by equality,
   typing errors, initials, short forms and abbreviations; rare tokens weigh more.  Two
   words that both stand in the catalogue are different words, not typing errors.
4. A name is linked when one entity stands out; where several do (an initial), the title
   the name was read from decides, otherwise nothing is linked.

Defined results: rows without an id take no part; null, empty and blank names give nothing; repeated rows are linked each;
a name equal to a catalogue spelling is left out of ``variants``; ties between entities
give no link; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showgrain.functions.frames import frame
from showgrain.functions.text import bare, mixed_script_fold
from showgrain.session import broadcast_if_small, spread, written

Q = 2
EDITS = 2  # typing errors between two tokens that may be one word
BROKEN = 3  # grams that one error changes at most (a swap of neighbours)
ACCEPT = 0.72  # soft weighted similarity of a link
NEAREST = 0.06  # by which a token's other readings may be less similar than its best
MARGIN = 0.04  # by which the best entity leads
VOCABULARY_BOUND = 500_000  # catalogue tokens whose weights are sent to the tasks

# --- fixed values -----------------------------------------------------------------
#: Kinds of ensembles, which people drop, shorten and move.
KIND_WORDS = "band trio quartet quintet sextet duo orchestra ensemble collective project revival society brothers sisters choir chorus group crew company machine".split()
#: Short forms that are not made of the word's own letters.
KIND_SHORT = {"3o": "trio", "4tet": "quartet", "5tet": "quintet", "6tet": "sextet", "bros": "brothers", "srs": "sisters", "sis": "sisters", "orch": "orchestra"}
#: Words without weight.
STOP_WORDS = "the an and und et of dj mc feat featuring".split()
#: Short forms of given names.
NICKNAMES = {
    "alexandra": "alex lexi sandra sasha allie", "alexander": "alex al sandy sasha xander", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny", "barbara": "barb babs",
    "catherine": "cathy cate kate kitty", "charles": "charlie chuck chas", "christopher": "chris kit topher", "christina": "chris tina", "daniel": "dan danny", "david": "dave davy", "deborah": "deb debbie",
    "donald": "don donny", "dorothy": "dot dottie dolly", "edward": "ed eddie ned ted teddy", "eleanor": "ellie nell nora", "elizabeth": "liz lizzie beth betty eliza libby bess", "eugene": "gene", "frances": "fran frannie", "francisco": "paco frank pancho cisco", "francis": "frank",
    "frederick": "fred freddie", "gabriel": "gabe", "gerald": "gerry jerry", "gregory": "greg", "guadalupe": "lupe lupita", "harold": "harry hal", "henry": "hank harry", "isidore": "izzy", "jacob": "jake", "james": "jim jimmy jamie", "jennifer": "jen jenny", "jessica": "jess jessie", "john": "jack johnny", "jonathan": "jon", "jose": "pepe", "joseph": "joe joey", "joshua": "josh",
    "katherine": "kate katie kathy kat kitty", "kenneth": "ken kenny", "lawrence": "larry laurie", "leonard": "len lenny leo", "louis": "lou louie", "margaret": "maggie meg peggy marge greta", "matthew": "matt", "michael": "mike mick mickey", "nathaniel": "nate nat nathan", "nicholas": "nick nicky", "octavia": "tavi tavia", "patricia": "pat patty tricia", "patrick": "pat paddy", "penelope": "penny nell", "peter": "pete", "philip": "phil", "quentin": "quent quin",
    "rebecca": "becky becca", "richard": "rich rick dick ricky", "robert": "bob rob bobby robbie bert", "ronald": "ron ronnie", "samuel": "sam sammy", "samantha": "sam", "stephen": "steve", "steven": "steve", "susan": "sue susie", "theodore": "ted teddy theo", "thomas": "tom tommy", "timothy": "tim", "ulysses": "uly", "victoria": "vicky tori vic", "vincent": "vince vinny", "walter": "walt", "william": "will bill billy liam", "yolanda": "yoli", "zachary": "zach zack",
}
# ----------------------------------------------------------------------------------

_KINDS, _STOPS = frozenset(KIND_WORDS), frozenset(STOP_WORDS)
_NICK = {n: frozenset(s.split()) for n, s in NICKNAMES.items()}
_SHORT: dict[str, list[str]] = {}
for _n, _forms in NICKNAMES.items():
    for _s in _forms.split():
        _SHORT.setdefault(_s, []).append(_n)
_CAMEL = re.compile(r"(?<=[a-zà-ÿ]{2})(?=[A-Z][a-zà-ÿ])")
_TOKEN = re.compile(r"[^\W_]+")


def tokens(name: str) -> list[str]:
    """Bare lower-case tokens of a name; joined capitals part."""
    return _TOKEN.findall(bare(_CAMEL.sub(" ", mixed_script_fold(name))))


@lru_cache(maxsize=200_000)
def damerau(a: str, b: str, most: int = 3) -> int:
    """Edits (insert, delete, replace, swap of neighbours) between two words, ``most`` at most."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) >= most:
        return most
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            row.append(v)
        if min(row) >= most:
            return most
        before, last = last, row
    return min(last[-1], most)


def _abbreviates(short: str, full: str) -> bool:
    """A short form: begins alike, letters in order, clearly shorter."""
    if not (2 <= len(short) < len(full)) or short[0] != full[0]:
        return False
    it = iter(full)
    return all(c in it for c in short)


def _swaps(short: str) -> list[str]:
    """The word, and the word with two neighbours swapped."""
    return [short, *(short[:i] + short[i + 1] + short[i] + short[i + 2 :] for i in range(len(short) - 1))]


def kind_of(token: str, vocabulary) -> str | None:
    """The kind word a token stands for, also misspelt or shortened."""
    if token in _KINDS:
        return token
    if token in KIND_SHORT:
        return KIND_SHORT[token]
    if vocabulary(token):
        return None
    for k in KIND_WORDS:
        if any(_abbreviates(x, k) for x in _swaps(token)) or len(token) > 3 and damerau(token, k) <= (1 if len(k) < 6 else 2) or len(k) <= 5 and len(token) >= 3 and damerau(token, k) == 1:
            return k
    return None


def token_similarity(typed: str, real: str, vocabulary) -> float:
    """How well a typed token stands for a real one, 0 to 1."""
    if typed == real:
        return 1.0
    if len(typed) == 1:
        return 0.8 if real[0] == typed else 0.0
    if typed in _NICK.get(real, ()) or real in _NICK.get(typed, ()):
        return 0.95
    if vocabulary(typed):
        return 0.0
    n = max(len(typed), len(real))
    d = damerau(typed, real)
    if d <= (0 if n <= 2 else 1 if n <= 4 else 2):
        return 1 - 0.08 * d - (0.1 if typed[0] != real[0] else 0)
    return 0.0


def similarity(typed: list[str], real: list[str], weight, vocabulary) -> tuple[float, bool]:
    """Soft weighted similarity of two token lists, and whether it rests on an initial."""
    t_core, t_kind = _parted(typed, vocabulary)
    r_core, r_kind = _parted(real, vocabulary)
    if not t_core or not r_core:
        t_core, r_core, t_kind, r_kind = t_core + t_kind, r_core + r_kind, [], []
        if not t_core or not r_core:
            return 0.0, False
    if len(t_core) != len(r_core) and all(len(x) > 1 for x in t_core):
        joined = "".join(t_core)
        for order in (r_core, r_core[::-1]):
            d = damerau(joined, "".join(order))
            if len(joined) >= 7 and d <= 2 and (t_kind == r_kind or not t_kind or not r_kind):
                return 0.98 - 0.06 * d, False
    if t_kind and r_kind and set(t_kind) != set(r_kind):
        return 0.0, False
    left, total, got, initial = list(r_core), 0.0, 0.0, False
    for t in sorted(t_core, key=len, reverse=True):
        best, at = 0.0, -1
        for i, r in enumerate(left):
            s = token_similarity(t, r, vocabulary)
            if s > best:
                best, at = s, i
        w = weight(left[at]) if at >= 0 else weight(t)
        total += w
        if at >= 0:
            got += w * best
            initial |= len(t) == 1 and len(left[at]) > 1
            left.pop(at)
    total += sum(map(weight, left))
    score = got / total
    # a kind that only one side names costs little, more where the catalogue has none
    if t_kind != r_kind:
        score -= 0.02 if not t_kind else 0.05
    return score, initial


def _parted(toks: list[str], vocabulary) -> tuple[list[str], list[str]]:
    core, kinds = [], []
    for i, t in enumerate(toks):
        if t in _STOPS or i in (0, len(toks) - 1) and 2 <= len(t) <= 4 and damerau(t, "the") <= 1 and not vocabulary(t):
            continue
        k = kind_of(t, vocabulary) if len(toks) > 1 and i in (0, len(toks) - 1, len(toks) - 2) else None
        if k and (i > 0 or len(toks) > 2):
            kinds.append(k)
        else:
            core.append(t)
    return core, kinds


def _token_rows(column: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(toks=[tokens(x) for x in b[column]])

    return run


def _with_tokens(df: DataFrame, column: str) -> DataFrame:
    return df.mapInPandas(_token_rows(column), T.StructType([*df.schema.fields, T.StructField("toks", T.ArrayType(T.StringType()))]))


def _key_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The tokens that can tell a spelling: all but stop and kind words, and the joined whole."""
    for b in batches:
        s, k, n, trust = [], [], [], []
        for spelling, toks, trusted in zip(b.spelling, b.toks, b.trusted, strict=True):
            core = [t for t in toks if t not in _STOPS and t not in _KINDS] or list(toks)
            keys = set(core)
            if 1 < len(core) <= 4:
                keys |= {"".join(core), "".join(core[::-1])}
            s += [spelling] * len(keys)
            k += sorted(keys)
            n += [len(set(core)) if x in core else 0 for x in sorted(keys)]
            trust += [bool(trusted)] * len(keys)
        yield frame({"spelling": s, "real": k, "n_core": n, "trusted": trust})


def _gram_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per gram of a token and place of it (counted from 0)."""
    for b in batches:
        t, g, p, n = [], [], [], []
        for token in b.token:
            w = f"^{token}$"
            t += [token] * (len(w) - Q + 1)
            g += [w[i : i + Q] for i in range(len(w) - Q + 1)]
            p += range(len(w) - Q + 1)
            n += [len(token)] * (len(w) - Q + 1)
        yield frame({"token": t, "gram": g, "place": p, "len": n})


def _prefixed(df: DataFrame, order: DataFrame) -> DataFrame:
    """One row per prefix gram (with its place) of each token, rarest grams first."""
    long = df.join(order, "gram", "left")
    sets = long.groupBy("token", "len").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("freq", F.lit(0)).alias("f"), "gram", "place"))).alias("g"))
    # of len + 1 grams, so many stay whatever the edits: all but one of the others may be left out
    kept = F.greatest(F.lit(1), F.col("len") + 1 - EDITS * BROKEN)
    return sets.select("token", "len", F.explode(F.slice("g", F.lit(1), F.size("g") - kept + 1)).alias("x")).select("token", "len", "x.gram", "x.place")


def _verify_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    never = lambda _: False
    for b in batches:
        out = b.assign(sim=[token_similarity(t, r, never) if len(r) < 12 else float(damerau(t, r) <= 2) for t, r in zip(b.token, b.real, strict=True)])
        yield out[out.sim > 0]


def _full_forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Given names a short form may stand for, and the short forms of a given name."""
    for b in batches:
        pairs = [(t, n) for t in b.token for n in _SHORT.get(t, ())] + [(t, s) for t in b.token for s in sorted(_NICK.get(t, ()))]
        yield pd.DataFrame(pairs, columns=["token", "real"]).assign(sim=0.95)


def similar_tokens(typed: DataFrame, real: DataFrame) -> DataFrame:
    """Pairs (``token``, ``real``, ``sim``) of typed and catalogue tokens that may be one word.

    A prefix-filtered similarity join on the tokens' q-grams (``EDITS`` typing errors), equal
    tokens and short given names; both inputs hold distinct tokens.  ``real`` also says whether
    a token is ``trusted``, that is, stands in a name: a word that stands only in aliases may
    be a typing error itself, so meeting it does not rule out other readings.
    """
    real = written(real, "real-tokens")
    n_real = real.count()
    small = lambda d: broadcast_if_small(d, rows=n_real)
    trusted = small(real.filter("trusted").select("token"))
    equal = typed.join(small(real.select(F.col("token").alias("real"))), F.col("token") == F.col("real")).select("token", "real", F.lit(1.0).alias("sim"))
    short = typed.mapInPandas(_full_forms, "token string, real string, sim double").join(small(real.select(F.col("token").alias("real"))), "real", "left_semi").select("token", "real", "sim")
    grams = "token string, gram string, place int, len int"
    a = typed.filter(F.length("token") > 1).join(trusted, "token", "left_anti").mapInPandas(_gram_rows, grams)
    b = real.filter(F.length("token") > 1).select("token").mapInPandas(_gram_rows, grams)
    a, b = written(a, "typed-grams"), written(b, "real-grams")
    order = broadcast_if_small(written(b.groupBy("gram").agg(F.count("*").alias("freq")), "gram-order"))
    around = lambda c: F.explode(F.sequence(F.col(c) - EDITS, F.col(c) + EDITS)).alias(c)
    left = _prefixed(a, order).select("token", "gram", around("len"), "place").select("token", "gram", "len", around("place"))
    right = _prefixed(b, order).select(F.col("token").alias("real"), "gram", "len", "place")
    pairs = left.join(right, ["gram", "len", "place"]).select("token", "real").distinct()
    fuzzy = pairs.mapInPandas(_verify_tokens, "token string, real string, sim double")
    found = equal.unionByName(short).unionByName(fuzzy).groupBy("token", "real").agg(F.max("sim").alias("sim"))
    # a word is read in its nearest sense: one typing error away beats two
    found = found.join(small(real.select(F.col("token").alias("real"), "trusted")), "real")
    found = found.withColumn("top", F.max(F.when(F.col("trusted"), F.col("sim"))).over(Window.partitionBy("token")))
    return found.filter(F.coalesce(F.col("sim") >= F.col("top") - NEAREST, F.lit(True))).select("token", "real", "sim")


def candidates(typed: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (``name``, ``spelling``) that share enough similar tokens.

    typed: ``name``, ``toks``; known: ``spelling``, ``toks``, ``trusted``; both distinct.  Every core token
    of a spelling must be met, but for one that an initial may stand for.
    """
    keys = written(known.mapInPandas(_key_rows, "spelling string, real string, n_core int, trusted boolean"), "keys")
    typed_tokens = typed.select("name", F.explode(F.array_distinct("toks")).alias("token"))
    has_initial = F.exists("toks", lambda t: F.length(t) == 1)
    alike = written(similar_tokens(typed_tokens.select("token").distinct(), keys.groupBy(F.col("real").alias("token")).agg(F.max("trusted").alias("trusted"))), "similar-tokens")
    met = typed_tokens.join(broadcast_if_small(alike, 200_000), "token").groupBy("name").agg(F.collect_set("real").alias("met"))
    flags = typed.select("name", "toks", has_initial.alias("initial")).join(met, "name")
    # a spelling is asked for by its rarest word only, or its whole in one piece
    often = keys.groupBy("real").agg(F.count("*").alias("often"))
    rare = F.row_number().over(Window.partitionBy("spelling", F.col("n_core") == 0).orderBy("often", "real"))
    ranked = keys.join(often, "real").withColumn("rank", rare)
    core = ranked.filter("n_core > 0").groupBy("spelling").agg(F.collect_set("real").alias("core"), F.max("n_core").alias("n_core"))
    doors = ranked.filter("rank <= 2 or n_core = 0").select("spelling", "real", F.when(F.col("n_core") == 0, 0).otherwise(F.col("rank")).alias("rank"))
    doors = doors.join(core, "spelling")
    hits = flags.withColumn("real", F.explode("met")).join(broadcast_if_small(doors, 200_000), "real").filter("rank <= 1 or initial")
    n_met = F.size(F.array_intersect("met", "core"))
    hits = hits.filter((F.col("rank") == 0) | (n_met >= F.col("n_core") - F.when(F.col("initial"), 1).otherwise(0)))
    pairs = hits.select("name", "toks", "spelling").distinct()
    return pairs.join(broadcast_if_small(known.select("spelling", F.col("toks").alias("real_toks"))), "spelling")


def _verify(shared, unseen: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = shared.value
        vocabulary = weights.__contains__
        weight = lambda t: weights.get(t, unseen)
        for b in batches:
            scored = [similarity(list(t), list(r), weight, vocabulary) for t, r in zip(b.toks, b.real_toks, strict=True)]
            out = b[["name", "spelling"]].assign(score=[s for s, _ in scored], initial=[i for _, i in scored])
            yield out[out.score >= ACCEPT]

    return run


def token_weights(catalogue: DataFrame) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the tokens of catalogue names, and that of an unseen token."""
    n = catalogue.count()
    df = (
        _with_tokens(catalogue.select("name").filter("name is not null"), "name")
        .select(F.explode(F.array_distinct("toks")).alias("t")).groupBy("t").count()
    )
    held = df.limit(VOCABULARY_BOUND + 1).collect()
    if len(held) > VOCABULARY_BOUND:
        raise ValueError(f"over {VOCABULARY_BOUND} distinct catalogue tokens; raise VOCABULARY_BOUND to the executors' memory")
    return {r.t: math.log(1 + n / r["count"]) for r in held}, math.log(1 + max(n, 1))


def _decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Resolve names whose best entities rest on an initial or tie, by the title."""
    for b in batches:
        keep = []
        for title, rivals in zip(b.original_title, b.rivals, strict=True):
            keep.append(decide(title, [(r["artist_id"], r["score"], r["initial"], r["artist_name"]) for r in rivals]))
        yield b.assign(artist_id=keep).dropna(subset=["artist_id"])[["name", "original_title", "artist_id"]]


def decide(title: str | None, rivals: list[tuple[str, float, bool, str]]) -> str | None:
    """The one entity meant; rivals: id, score, rests on an initial, catalogue name."""
    best = max(r[1] for r in rivals)
    near = [r for r in rivals if r[1] >= best - MARGIN]
    if not any(r[2] for r in near):
        return near[0][0] if len({r[0] for r in near}) == 1 else None
    said = tokens(title or "")
    agreed, denied = [], set()
    for r in near:
        real = [t for t in tokens(r[3]) if t not in _STOPS]
        first, rest = real[0], set(real[1:])
        places = [i for i, t in enumerate(said) if t in rest or any(len(t) > 3 and damerau(t, x) <= 2 for x in rest)]
        around = {said[j] for i in places for j in (i - 1, i + 1) if 0 <= j < len(said) and len(said[j]) > 1}
        if any(token_similarity(t, first, lambda _: False) > 0.5 for t in around):
            agreed.append(r)
        elif any(t[0] == first[0] and len(t) > 2 for t in around):
            denied.add(r[0])
    if agreed:
        return agreed[0][0] if len({r[0] for r in agreed}) == 1 else None
    left = [r for r in near if r[0] not in denied]
    return left[0][0] if len({r[0] for r in left}) == 1 else None


def variants(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``_ord`` and ``artist_id`` of rows whose ``extracted_band_name`` varies a catalogue name.

    rows: ``_ord``, ``extracted_band_name``, ``original_title``; catalogue: ``id``, ``name``, ``aliases``.
    """
    spelled = (
        catalogue.filter("id is not null")
        .select("id", F.col("name").alias("artist_name"), F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("spelling"))
        .filter("coalesce(trim(spelling), '') <> ''")
        .distinct()
    )
    spelled = written(spelled, "spellings")
    n_spelled = spelled.count()
    names = rows.filter("_ord is not null and coalesce(trim(extracted_band_name), '') <> ''").select("_ord", F.col("extracted_band_name").alias("name"), "original_title")
    exact = spelled.select(F.col("spelling").alias("name")).distinct()
    open_names = names.join(broadcast_if_small(exact, rows=n_spelled), "name", "left_anti")
    typed = written(_with_tokens(spread(open_names.select("name").distinct()), "name"), "typed")
    known = written(_with_tokens(spelled.groupBy("spelling").agg(F.max(F.col("spelling") == F.col("artist_name")).alias("trusted")), "spelling"), "known")
    weights, unseen = token_weights(catalogue)
    pairs = candidates(typed, known)
    scored = spread(pairs).mapInPandas(_verify(rows.sparkSession.sparkContext.broadcast(weights), unseen), "name string, spelling string, score double, initial boolean")
    scored = scored.join(broadcast_if_small(spelled, rows=n_spelled), "spelling").withColumnRenamed("id", "artist_id")
    best = scored.groupBy("name", "artist_id", "artist_name").agg(F.max_by(F.struct("score", "initial"), F.struct("score", ~F.col("initial"))).alias("b"))
    best = best.withColumn("top", F.max("b.score").over(Window.partitionBy("name"))).filter(F.col("b.score") >= F.col("top") - MARGIN)
    rivals = written(
        best.groupBy("name").agg(F.collect_list(F.struct("artist_id", F.col("b.score").alias("score"), F.col("b.initial").alias("initial"), "artist_name")).alias("rivals")),
        "rivals",
    )
    clear = rivals.filter((F.size("rivals") == 1) & ~F.col("rivals")[0]["initial"]).select("name", F.col("rivals")[0]["artist_id"].alias("artist_id"))
    doubtful = rivals.join(clear, "name", "left_anti")
    by_title = (
        doubtful.join(open_names.select("name", "original_title").distinct(), "name")
        .mapInPandas(_decide, "name string, original_title string, artist_id string")
    )
    first = open_names.join(clear, "name").select("_ord", "artist_id")
    second = open_names.alias("o").join(
        by_title.alias("t"), (F.col("o.name") == F.col("t.name")) & F.col("o.original_title").eqNullSafe(F.col("t.original_title"))
    ).select("_ord", "artist_id")
    return first.unionByName(second)
