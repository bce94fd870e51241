"""Spellings of names that stand for the same person or organisation.

Names are brought to tokens: wrong decodings restored, marks and case folded,
titles and placeholders dropped, abbreviations and short given names written out.
A person is a family name with a given name, an organisation a set of common words
(what it is) with its rare ones (where it is).

Tokens typed with an error are found by suffix blocking. Every suffix of a token
and of its reverse is indexed from a least length on, within what else is known of
the name. A block of more than BLOCK tokens is refined, with the token's other end
and with all that one slip leaves of it, and only what lies in a block together is
compared, by the ratio of the longest common subsequence, many pairs
at a time on the bits of whole numbers. Suffixes that are still too common are
left to the refined blocks; there every pair of one slip meets again.

Which short forms stand for which given names is taken from a general list and
learned where names share an identifier. No threshold depends on the size of the
table: forms are weighed against each other.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.encoding import garbled_texts
from siltstone.runtime import materialise

LEAST_RATIO = 0.8
#: A form is a slip for one that is in so many times as many names.
COMMONER = 10
#: Up to so many names may hold the same slip by chance, however rare the right form is.
SLIP_SPELLINGS = 2
#: Tokens of a block that are compared with each other; larger blocks are refined.
BLOCK = 30
#: People under whose identifiers a short form must stand for a given name to be learned.
LEAST_PEOPLE = 2
#: Places before a word behind the last comma that show it to be a country or region.
LEAST_PLACES = 3

# Titles, placeholders and words without weight.
TITLES = {"dr", "prof", "professor", "phd", "md", "msc", "bsc", "mr", "mrs", "ms", "sir", "jr", "sr"}
PLACEHOLDERS = {"", "na", "none", "null", "unknown", "anonymous", "tbd", "notavailable", "notgiven", "unspecified", "nil", "anon", "test", "various", "etal"}
STOP_WORDS = {"of", "for", "the", "and", "in", "at", "f", "de", "der", "la"}
# Words that say what kind an organisation is, and their short forms.
KINDS = {
    "academy": "acad", "agency": "", "agricultural": "agric", "applied": "appl", "astronomical": "astr astron", "association": "assoc", "authority": "auth", "biological": "biol", "botanical": "bot", "bureau": "",
    "centre": "cent center ctr", "chemical": "chem", "clinic": "clin", "college": "coll", "committee": "comm", "computing": "comput", "council": "", "department": "dept", "division": "div", "economics": "econ",
    "education": "educ", "engineering": "eng engn", "environmental": "environ", "faculty": "fac", "federal": "fed", "field": "", "foundation": "found", "garden": "gdn gard gardens", "general": "gen", "geological": "geol",
    "group": "grp", "health": "hlth", "history": "hist", "hospital": "hosp", "institute": "inst institution", "international": "intl int", "laboratory": "lab labs", "library": "libr", "marine": "mar", "mathematics": "math",
    "medical": "med", "medicine": "", "ministry": "minist", "museum": "mus", "national": "natl", "natural": "nat", "observatory": "obs", "ocean": "oc", "office": "off", "park": "", "physics": "phys", "polytechnic": "polytech",
    "programme": "program prog", "project": "proj", "regional": "reg", "research": "res", "royal": "roy", "school": "sch", "sciences": "sci science", "service": "serv services", "social": "soc", "society": "", "state": "",
    "station": "stn", "studies": "stud", "survey": "surv", "technical": "", "technology": "tech technol", "trust": "", "university": "univ universitaet", "veterinary": "vet",
}
# Short forms of given names in common use.
PET_FORMS = {
    "abigail": "abby", "albert": "al bert", "alexander": "alex al sandy sasha xander", "alexandra": "alex sandra sasha", "alfred": "alf fred", "andrew": "andy drew", "anthony": "tony", "arthur": "art", "barbara": "barb babs", "benjamin": "ben benny",
    "bernard": "bernie", "catherine": "cathy cath cat kate katie kitty", "charles": "charlie chuck", "charlotte": "lottie", "christina": "tina chris", "christopher": "chris kit", "cynthia": "cindy", "daniel": "dan danny", "david": "dave", "deborah": "deb debbie",
    "donald": "don", "dorothy": "dot dolly", "edward": "ed eddie ned ted", "eleanor": "ellie nell nora", "elizabeth": "liz lizzy beth betty betsy eliza libby lisa", "emily": "em emmy", "eugene": "gene", "florence": "flo", "frances": "fran", "francis": "frank",
    "frederick": "fred freddy fritz rick", "gabriella": "gabi gabby ella", "george": "georgie", "gerald": "gerry jerry", "gregory": "greg", "harold": "harry hal", "helen": "nell", "henrietta": "hetty etta", "henry": "harry hank", "isabella": "bella izzy isa",
    "jacob": "jake", "james": "jim jimmy jamie", "jennifer": "jen jenny", "johannes": "hans jan", "john": "johnny jack", "jonathan": "jon jonny nathan", "joseph": "joe joey", "josephine": "josie jo", "katherine": "kate kathy katie kit", "kenneth": "ken kenny",
    "konstantin": "kostya kosta", "lawrence": "larry", "leonard": "len lenny leo", "leonardo": "leo", "louis": "lou", "margaret": "maggie meg peggy greta rita marge daisy", "maria": "mia", "martin": "marty", "matthew": "matt", "michael": "mike mick micky",
    "natalia": "natasha", "nathaniel": "nate nat", "nicholas": "nick nicky nico klaus colin", "olivia": "liv", "pamela": "pam", "patricia": "pat patty trish tricia", "patrick": "pat paddy", "peter": "pete", "philip": "phil", "raymond": "ray",
    "rebecca": "becca becky", "richard": "dick rick rich richie", "robert": "rob bob bobby robbie bert", "ronald": "ron ronnie", "rosemary": "rose rosie", "samantha": "sam sammy", "samuel": "sam sammy", "sarah": "sally sadie", "stephen": "steve", "susan": "sue susie",
    "theodore": "ted teddy theo", "theresa": "terry tess", "thomas": "tom tommy", "timothy": "tim", "ursula": "ulla uschi", "valentina": "val", "victoria": "vicky tori", "vincent": "vince", "vladimir": "vova", "walter": "walt wally", "wilhelm": "willi willy", "william": "will bill billy willy liam", "zachary": "zach zack zak",
}
_KIND_OF = {w: k for k, short in KINDS.items() for w in (k, *short.split())}
_FOLD = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d", "ı": "i"})
_WORD = re.compile(r"[^\W\d_]+")


def fold(s: str) -> str:
    """Lower case without marks."""
    s = unicodedata.normalize("NFKD", s.lower().translate(_FOLD))
    return "".join(c for c in s if not unicodedata.combining(c)).translate(_FOLD)


def is_placeholder(name: str) -> bool:
    return re.sub(r"[\W_]", "", fold(name)) in PLACEHOLDERS


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table at a time on the bits of one number."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    mask = row = (1 << len(a)) - 1
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & mask
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Longest common subsequence against the mean length."""
    return 2 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 1.0


def one_slip(a: str, b: str) -> bool:
    """Whether the tokens are equal but for one place of at most two letters, altered or
    exchanged, one of them put in or left out."""
    if abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    p = next((i for i in range(short) if a[i] != b[i]), short)
    s = next((i for i in range(short - p) if a[-1 - i] != b[-1 - i]), short - p)
    return p + s >= max(len(a), len(b)) - 2


def person_parts(name: str) -> tuple[str, str, list[str], bool] | None:
    """First and second full part, initials, and whether a comma says that the
    first is the family name; None if there is no name. Without a comma the order
    is open: the parts are given as they stand."""
    if is_placeholder(name):
        return None
    name = re.sub(r"[�]", "", name)
    parts = [_WORD.findall(p) for p in name.split(",")]
    # Two capitals behind a lone family name are initials, whatever title they spell.
    bare = len(parts) == 1 and len(parts[0]) == 2 and len(parts[0][1]) <= 3 and parts[0][1].isupper() and not parts[0][0].isupper()
    parts = [p if bare else [w for w in p if fold(w) not in TITLES] for p in parts]
    parts = [p for p in parts if p]
    if not parts:
        return None
    comma = len(parts) > 1
    words = [w for p in parts for w in p]
    short = lambda i, w: len(w) == 1 or (len(w) <= 3 and w.isupper() and i == len(words) - 1 and len(words) == 2 and not comma)
    initials = [fold(c) for i, w in enumerate(words) if short(i, w) for c in w]
    full = [fold(w) for i, w in enumerate(words) if not short(i, w)]
    if not full:
        return None
    if comma:
        family = [fold(w) for w in parts[0] if len(w) > 1]
        given = [fold(w) for p in parts[1:] for w in p if len(w) > 1]
        return (" ".join(family), " ".join(given), initials, True) if family else None
    return (full[0], " ".join(full[1:]), initials, len(full) == 1)


_PARTS = "name string, one string, two string, initial string, sure boolean"


def _persons(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        out = []
        for name, said in zip(p["name"], p["said"]):
            got = person_parts(said)
            if got:
                one, two, initials, sure = got
                out.append((name, one, two, initials[0] if initials else "", sure))
        yield pd.DataFrame(out, columns=["name", "one", "two", "initial", "sure"])


def least_suffix(n: int) -> int:
    """The shortest suffix of a token of n letters that is indexed; a slip in a token
    leaves one of at least that length at its end or its beginning."""
    return 3 if n >= 7 else 2 if n >= 5 else 1


def suffixes(token: str) -> list[str]:
    """Every suffix of a token and of its reverse, from the least length on."""
    n, least = len(token), least_suffix(len(token))
    return [f">{token[n - k :]}" for k in range(least, n + 1)] + [f"<{token[:k]}" for k in range(least, n)]


def refined(token: str) -> str:
    """The shortest suffix, where it is common, with as many letters of the beginning."""
    k = least_suffix(len(token))
    return f"{token[:k]}/{token[len(token) - k :]}"


def shapes(token: str) -> list[str]:
    """What is left of a token by a gap of one or two letters, the gap marked: tokens of one slip have one in common."""
    n = len(token)
    return sorted({f"{token[:p]} {token[p + g :]}" for g in (1, 2) for p in range(n - g + 1) if n - g >= 1})


def _keys(batches: Iterator[pa.RecordBatch], keys) -> Iterator[pa.RecordBatch]:
    """(context, token, n, ...) with a row for each key of a row."""
    for b in batches:
        rows = b.to_pylist()
        each = [keys(r) for r in rows]
        at = pa.array([i for i, ks in enumerate(each) for _ in ks], pa.int64())
        t = b.select(["context", "token", "n"]).take(at)
        yield pa.RecordBatch.from_arrays([*t.columns, pa.array([k for ks in each for k in ks], pa.string())], names=["context", "token", "n", "key"])


_KEYED = "context string, token string, n long, key string"


def _blocked(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of tokens in blocks of no more than BLOCK, and the rows of larger blocks."""
    sizes = keyed.groupBy("context", "key").agg(F.count("*").alias("size")).where("size > 1")
    sized = materialise(keyed.join(sizes, ["context", "key"]), "token-blocks")
    a = sized.where(F.col("size") <= BLOCK).drop("size")
    b = a.select("context", "key", F.col("token").alias("y"), F.col("n").alias("ny"))
    pairs = a.join(b, ["context", "key"]).where("token < y").select("context", F.col("token").alias("x"), "y", F.col("n").alias("nx"), "ny")
    return pairs, sized.where(F.col("size") > BLOCK).drop("size")


def close_tokens(tokens: DataFrame) -> DataFrame:
    """(token, context, n), each token once in its context -> (context, x, y, nx, ny,
    slips): pairs x < y of a context with a ratio of at least LEAST_RATIO, slips
    being 1 or more. Pairs of one slip are all there; of others those that share a
    suffix or prefix that is not too common. Empty tokens have no pairs."""
    t = tokens.where(F.length("token") > 0).select("context", "token", "n")
    pairs, large = _blocked(t.mapInArrow(lambda it: _keys(it, lambda r: [*suffixes(r["token"]), refined(r["token"])]), _KEYED))
    # Two tokens that share no block of those meet in large ones only: there by what one slip leaves.
    rest = large.select("context", "token", "n").distinct().mapInArrow(lambda it: _keys(it, lambda r: shapes(r["token"])), _KEYED)
    a, b = rest, rest.select("context", "key", F.col("token").alias("y"), F.col("n").alias("ny"))
    last = a.join(b, ["context", "key"]).where("token < y").select("context", F.col("token").alias("x"), "y", F.col("n").alias("nx"), "ny")
    every = pairs.unionByName(last).where(f"2 * least(length(x), length(y)) >= {LEAST_RATIO} * (length(x) + length(y)) / 1.0").distinct()

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column(1).to_pylist(), b.column(2).to_pylist()
            slips = [(1 if one_slip(p, q) else 2) if ratio(p, q) >= LEAST_RATIO else 0 for p, q in zip(x, y)]
            keep = pa.array([i for i, k in enumerate(slips) if k], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.take(keep).columns, pa.array([k for k in slips if k], pa.int32())], names=["context", "x", "y", "nx", "ny", "slips"])

    return every.select("context", "x", "y", "nx", "ny").mapInArrow(compared, "context string, x string, y string, nx long, ny long, slips int")


def slips(tokens: DataFrame) -> DataFrame:
    """As close_tokens, both ways round: x may be a slip for y."""
    c = materialise(close_tokens(tokens), "close-tokens")
    return c.unionByName(c.select("context", F.col("y").alias("x"), F.col("x").alias("y"), F.col("ny").alias("nx"), F.col("nx").alias("ny"), "slips"))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): smallest node of each component, by passing on the
    smallest label and jumping to labels' labels; each round is written out."""
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    moving = not both.isEmpty()
    while moving:
        near = both.join(label.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        best = label.join(near, "node", "left").select("node", "root", F.least("root", F.coalesce("near", "root")).alias("low"))
        jump = label.select(F.col("node").alias("low"), F.col("root").alias("far"))
        new = materialise(best.join(jump, "low", "left").select("node", F.least("low", F.coalesce("far", "low")).alias("root"), (F.col("root") != F.least("low", F.coalesce("far", "low"))).alias("moved")), "labels")
        label = new.select("node", "root")
        moving = not new.where("moved").isEmpty()
    return label


def _resolve(tokens: DataFrame) -> DataFrame:
    """(token, context, n) -> (token, context, root): one token for each set of slips.

    A token goes to the commonest one that it may be a slip for: by one slip if it
    is in few names, or in few against the other; by more only if it is in one name
    and the other in many. So two common tokens are never joined by a slip between
    them. Rare ones without such a neighbour go together.
    """
    node = lambda c, t: F.concat_ws("\x1f", c, t)
    pairs = slips(tokens)
    one = F.col("slips") == 1
    few = F.col("nx") <= SLIP_SPELLINGS
    against = F.col("nx") * COMMONER <= F.col("ny")
    goes = (one & ((few & (F.col("ny") > SLIP_SPELLINGS)) | against)) | (~one & (F.col("nx") == 1) & against)
    to_common = pairs.where(goes).groupBy("context", "x").agg(F.max_by("y", F.struct(-F.col("slips"), "ny", "y")).alias("y"))
    to_common = materialise(to_common, "slips")
    lone = pairs.where(one & few & (F.col("ny") <= SLIP_SPELLINGS)).join(to_common.select("context", "x"), ["context", "x"], "left_anti").join(to_common.select("context", F.col("x").alias("y")), ["context", "y"], "left_anti")
    roots = components(lone.select(node("context", "x").alias("a"), node("context", "y").alias("b")))
    of_rare = roots.select("node", F.element_at(F.split("root", "\x1f"), -1).alias("rare_root"))
    of_slip = to_common.select(node("context", "x").alias("node"), F.col("y").alias("common_root"))
    joined = tokens.withColumn("node", node("context", "token")).join(of_rare, "node", "left").join(of_slip, "node", "left")
    return joined.select("token", "context", F.coalesce("common_root", "rare_root", "token").alias("root"))


def restored_names(names: DataFrame) -> DataFrame:
    """(name) -> (name, said), each name once: wrong decodings undone as far as they can
    be. Null and blank names have no row."""
    n = names.where("name is not null and trim(name) <> ''").select("name").distinct()
    fixed = garbled_texts(n.select(F.lit("names").alias("source"), F.lit(0).alias("id"), F.lit(0).alias("pos"), F.col("name").alias("text")), rounds=2)
    fixed = fixed.select(F.col("text").alias("name"), "restored")
    return n.join(fixed, "name", "left").select("name", F.coalesce("restored", "name").alias("said"))


def _said(names: DataFrame) -> DataFrame:
    """names with what they say, restored here unless the column said comes along."""
    if "said" in names.columns:
        return names.where("name is not null and trim(name) <> ''").select("name", "said").dropDuplicates(["name"])
    return restored_names(names)


def short_forms(known: DataFrame, evidence: DataFrame) -> DataFrame:
    """known (name, family, given), evidence (name, identifier) -> (short, full): given
    names that stand for another under the same identifier and family, for several
    people. Each person's commonest given name counts as the full one."""
    by = known.where("given <> ''").join(evidence.where("identifier is not null and trim(identifier) <> ''").distinct(), "name")
    each = by.groupBy("identifier", "family", "given").agg(F.count("*").alias("n"))
    full = each.groupBy("identifier", "family").agg(F.max_by("given", F.struct(F.col("n"), F.length("given"), F.col("given"))).alias("full"))
    other = each.join(full, ["identifier", "family"]).where("given <> full and length(full) > 1")
    seen = other.groupBy(F.col("given").alias("short"), "full").agg(F.countDistinct("identifier").alias("people"))
    return seen.where(F.col("people") >= LEAST_PEOPLE).select("short", "full")


def resolve_persons(names: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """(name) -> (name, entity) of the names that stand for a person.

    Two names are one person if they agree in family name and given name but for
    a slip, a short form, initials, order, titles, case and marks. Initials stand
    for the only given name in the family that starts so, for no one if there are
    several. Short forms of several names stand for the one that the family has.
    evidence (name, identifier) says under which identifiers names stand; short
    forms are learned from it. Null, blank and placeholder names have no row; names
    may come with what they say when restored, as said.
    """
    said = _said(names)
    p = materialise(said.mapInPandas(_persons, _PARTS), "persons")
    # Which token is a given name: what stands behind commas elsewhere.
    sure = p.where("sure")
    role = (
        sure.select(F.col("one").alias("token"), F.lit(0).alias("g")).unionByName(sure.where("two <> ''").select(F.element_at(F.split("two", " "), 1).alias("token"), F.lit(1).alias("g")))
        .groupBy("token").agg(F.avg("g").alias("g"), F.sum("g").alias("n"))
    )
    last = F.element_at(F.split("two", " "), -1)
    open_ = p.where("not sure").withColumn("end", last)
    of = lambda c, out: role.select(F.col("token").alias(c), F.col("g").alias(out))
    open_ = open_.join(of("one", "g1"), "one", "left").join(of("end", "g2"), "end", "left")
    turned = F.coalesce("g1", F.lit(0.5)) < F.coalesce("g2", F.lit(0.5))
    settled = open_.select("name", F.when(turned, F.col("one")).otherwise(F.col("end")).alias("family"), F.when(turned, F.element_at(F.split("two", " "), 1)).otherwise(F.col("one")).alias("given"), "initial")
    known = sure.select("name", F.col("one").alias("family"), F.element_at(F.split(F.coalesce("two", F.lit("")), " "), 1).alias("given"), "initial").unionByName(settled)
    known = materialise(known, "person-names")
    # Slips in given names: rare ones against common ones.
    spark = names.sparkSession
    pets = spark.createDataFrame([(s_, f) for f, ss in PET_FORMS.items() for s_ in ss.split()], "short string, full string")
    given = known.where("given <> ''").groupBy("given").agg(F.countDistinct("family").alias("n"))
    spelt = given.select("given").union(pets.select("full")).distinct().select(F.col("given").alias("token"), F.lit("").alias("context"), F.lit(0).cast("long").alias("n"))
    near = slips(spelt).where("slips = 1").select("x", "y")
    counts = lambda c, n: given.select(F.col("given").alias(c), F.col("n").alias(n))
    to = near.join(counts("x", "nx"), "x").join(counts("y", "ny"), "y").where(F.col("ny") >= F.col("nx") * COMMONER).groupBy(F.col("x").alias("given")).agg(F.max_by("y", F.struct("ny", "y")).alias("better"))
    known = known.join(to, "given", "left").withColumn("given", F.coalesce("better", "given")).drop("better")
    known = materialise(known, "person-slips")
    # Short forms that several given names share keep an open place: the family decides.
    if evidence is not None:
        pets = pets.unionByName(short_forms(known, evidence))
    pets = pets.groupBy(F.col("short").alias("given")).agg(F.array_sort(F.collect_set("full")).alias("fulls"))
    known = known.join(pets, "given", "left")
    known = known.withColumn("could_be", F.coalesce("fulls", F.when(F.col("given") != "", F.array("given")).otherwise(F.array().cast("array<string>")))).drop("fulls")
    opened = known.withColumn("start", F.explode(F.when(F.size("could_be") > 0, F.array_distinct(F.transform("could_be", lambda c: F.substring(c, 1, 1)))).otherwise(F.array("initial"))))
    opened = materialise(opened.where("start <> '' and family <> ''"), "person-parts")
    fam = opened.groupBy(F.col("family").alias("token"), F.col("start").alias("context")).agg(F.countDistinct("name").alias("n"))
    roots = _resolve(fam).select(F.col("token").alias("family"), F.col("context").alias("start"), "root")
    r = materialise(opened.join(roots, ["family", "start"]), "person-roots")
    # Given names of one family that are a slip apart are one.
    fulls = r.where("size(could_be) = 1").groupBy(F.concat_ws("\x1f", "root", "start").alias("context"), F.col("could_be")[0].alias("token")).agg(F.countDistinct("name").alias("n"))
    fulls = fulls.join(fulls.groupBy("context").agg(F.count("*").alias("k")).where("k > 1").select("context"), "context")
    two = fulls.select("context", F.col("token").alias("x"), F.col("n").alias("nx")).join(near, "x").join(fulls.select("context", F.col("token").alias("y"), F.col("n").alias("ny")), ["context", "y"])
    same = two.where("struct(ny, y) > struct(nx, x)").groupBy("context", "x").agg(F.max_by("y", F.struct("ny", "y")).alias("better"))
    same = same.select(F.col("context").alias("family_context"), F.col("x").alias("slip"), "better")
    alone = F.when(F.size("could_be") == 1, F.try_element_at("could_be", F.lit(1)))
    r = r.withColumn("family_context", F.concat_ws("\x1f", "root", "start")).withColumn("slip", alone).join(same, ["family_context", "slip"], "left")
    r = r.withColumn("could_be", F.when(F.col("better").isNotNull(), F.array("better")).otherwise(F.col("could_be"))).select("name", "could_be", "start", "root")
    r = materialise(r, "person-variants")
    # The first three or four letters of a much longer given name of the family stand for it.
    fulls = r.where("size(could_be) = 1").select("root", "start", F.col("could_be")[0].alias("full")).distinct().withColumn("head", F.substring("full", 1, 3))
    cut = fulls.where("length(full) between 3 and 4").withColumnRenamed("full", "short").join(fulls, ["root", "start", "head"])
    cut = cut.where("length(short) <= 0.6 * length(full) and startswith(full, short)").groupBy("root", "start", "short").agg(F.count("*").alias("k"), F.min("full").alias("longer")).where("k = 1").drop("k")
    r = r.withColumn("short", F.when(F.size("could_be") == 1, F.try_element_at("could_be", F.lit(1)))).join(cut, ["root", "start", "short"], "left")
    r = r.withColumn("could_be", F.when(F.col("longer").isNotNull(), F.array("longer")).otherwise(F.col("could_be"))).select("name", "could_be", "start", "root")
    r = materialise(r, "person-givens")
    full = r.where("size(could_be) = 1").select("root", "start", F.col("could_be")[0].alias("full")).distinct()
    n_full = full.groupBy("root", "start").agg(F.count("*").alias("n_full"), F.min("full").alias("only"))
    at = materialise(r.join(n_full, ["root", "start"], "left"), "person-fulls")
    exact = at.where("size(could_be) = 1").select("name", F.concat_ws("|", "root", F.col("could_be")[0]).alias("entity"))
    by_initial = at.where("size(could_be) = 0 and n_full = 1").select("name", F.concat_ws("|", "root", "only").alias("entity"))
    # Without a full name, a lone short form of several is what initials stand for.
    pets_of = at.where("size(could_be) > 1 and n_full is null").groupBy("root", "start").agg(F.countDistinct("could_be").alias("n_pets"), F.min(F.col("could_be")[0]).alias("pet"))
    alone = at.where("size(could_be) = 0 and n_full is null").join(pets_of, ["root", "start"], "left")
    lonely = alone.select("name", F.concat_ws("|", "root", F.when(F.col("n_pets") == 1, F.col("pet")).otherwise(F.concat("start", F.lit(".")))).alias("entity"))
    by_pet = at.where("size(could_be) > 1 and n_full = 1 and array_contains(could_be, only)").select("name", F.concat_ws("|", "root", "only").alias("entity"))
    only_once = by_pet.groupBy("name").agg(F.count("*").alias("k"), F.min("entity").alias("entity")).where("k = 1").drop("k")
    open_pet = at.where("size(could_be) > 1 and start = substring(could_be[0], 1, 1)").join(only_once.select("name"), "name", "left_anti")
    open_pet = open_pet.select("name", F.concat_ws("|", "root", F.col("could_be")[0]).alias("entity"))
    return exact.unionByName(by_initial).unionByName(lonely).unionByName(only_once).unionByName(open_pet).distinct()


_ORG = "name string, kinds array<string>, words array<string>, last string"
_KIND_SHAPES: dict[str, str] = {}
for _w, _k in sorted(_KIND_OF.items(), reverse=True):
    if len(_w) >= 4:
        for _s in shapes(_w):
            _KIND_SHAPES[_s] = _w


def kind_of(word: str) -> str | None:
    """The kind of organisation that a word says, also with a slip; None for other words."""
    if word in _KIND_OF:
        return _KIND_OF[word]
    if len(word) < 4:
        return None
    near = sorted({_KIND_SHAPES[s] for s in shapes(word) if s in _KIND_SHAPES})
    return next((_KIND_OF[w] for w in near if one_slip(w, word) and (ratio(w, word) >= LEAST_RATIO or sorted(w) == sorted(word))), None)


def _organisations(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        out = []
        for name, said in zip(p["name"], p["said"]):
            if is_placeholder(said):
                continue
            words = [fold(w) for w in _WORD.findall(re.sub("�", "", said))] + re.findall(r"\d+", said)
            words = [w for w in words if w not in STOP_WORDS]
            kinds = {w: kind_of(w) for w in words}
            found = _WORD.findall(fold(said.rpartition(",")[2]) if "," in said else "")
            if words:
                out.append((name, sorted({k for k in kinds.values() if k}), sorted({w for w in words if not kinds[w]}), found[0] if len(found) == 1 else ""))
        yield pd.DataFrame(out, columns=["name", "kinds", "words", "last"])


def resolve_organisations(names: DataFrame) -> DataFrame:
    """(name) -> (name, entity) of the names that stand for an organisation.

    Two names are one organisation if they agree in their words of kind as a set,
    short forms written out, and in their other words but for a slip. A word that
    stands behind the last comma in nearly all its names, beside LEAST_PLACES
    different ones, or beside one that other names know in front of it, only says
    where the place is and doesn't count. Null, blank and placeholder names have no
    row; names may come with what they say when restored, as said.
    """
    o = materialise(_said(names).mapInPandas(_organisations, _ORG), "organisations")
    words = o.select("name", "last", "words", F.explode("words").alias("word"))
    behind = F.col("word") == F.col("last")
    front = F.explode_outer(F.when(behind, F.array_except("words", F.array("last"))))
    stats = words.groupBy("word").agg(F.count("*").alias("n"), F.avg(behind.cast("double")).alias("tail"))
    beside = words.select("word", front.alias("place")).where("place is not null").groupBy("word").agg(F.countDistinct("place").alias("places"))
    stats = materialise(stats.join(beside, "word", "left"), "words")
    w = words.select("name", "last", "word").join(stats, "word")
    is_last, tail = F.col("word") == F.col("last"), F.col("tail") >= 0.9
    sig = w.groupBy("name").agg(
        F.array_sort(F.collect_set("word")).alias("rare"),
        F.first("last").alias("last"),
        F.bool_or(is_last & tail).alias("only_behind"),
        F.bool_or(is_last & tail & (F.coalesce("places", F.lit(0)) >= LEAST_PLACES)).alias("is_region"),
        F.bool_or(~is_last & (F.col("n") >= 2)).alias("has_place"),
    )
    drop = (F.col("only_behind") & F.col("has_place")) | F.col("is_region")
    place = F.when(drop, F.array_except("rare", F.array("last"))).otherwise(F.col("rare"))
    sig = o.select("name", F.concat_ws(" ", "kinds").alias("what")).join(sig.select("name", F.concat_ws(" ", place).alias("where_")), "name", "left")
    sig = materialise(sig.withColumn("where_", F.coalesce("where_", F.lit(""))), "organisation-parts")
    tokens = sig.groupBy(F.col("where_").alias("token"), F.col("what").alias("context")).agg(F.count("*").alias("n"))
    roots = _resolve(tokens).select(F.col("token").alias("where_"), F.col("context").alias("what"), "root")
    return sig.join(roots, ["where_", "what"]).where("what <> '' or where_ <> ''").select("name", F.concat_ws("|", "root", "what").alias("entity"))


def same_entity_pairs(resolved: DataFrame) -> DataFrame:
    """(name, entity) -> (name_a, name_b), a < b by code point: all pairs of each entity."""
    once = materialise(resolved.select("entity", "name").distinct(), "entities")
    several = once.join(once.groupBy("entity").agg(F.count("*").alias("k")).where("k > 1").select("entity"), "entity")
    a, b = several.select("entity", F.col("name").alias("name_a")), several.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b").distinct()
