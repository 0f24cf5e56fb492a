"""Column expressions over titles, labels and paths (N1-N13, T1-T3). No Python runs per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Years, endings of paths by kind of page, languages and qualities at the end of paths and labels,
# noise words, and labels that name no title.
YEAR = r"(?:19[0-9]{2}|20[0-3][0-9])"
TYPE_ENDINGS = ("-(?:tamil-)?web-series", "-tamil-season-[0-9]+", "-tamil-dubbed-movie", "-tamil-movie", "-movie", "-(?:tamil-)?movie-[0-9]+")
LANGUAGES = "tamil|telugu|hindi|malayalam|kannada|english|dubbed"
EDITIONS = "hd|hq|original|proper|predvd|dvdrip|hdrip|tvrip|webrip|bluray|1080p|720p|480p|360p"
BRACKET_NOISE = "hd|dvd|web|blu|rip|1080p|720p|480p|360p|original|tamil|dubbed|proper|uncut"
WORD_NOISE = "hd|dvdrip|hdrip|webrip|web-dl|tvrip|hdtv|predvd|1080p|720p|480p|360p|x264|bluray|original|movie"
GENERIC_LABEL = (
    r"(?i)^(?:download(?:\s+now|\s+links?|\s+file)?|watch(?:\s+online)?|click\s+here|play(?:\s+now)?|full\s+movie|movie|"
    r"server\s*[0-9]*|link|file|zip|now|here|get\s+it|start\s+download)\z"
)
_S = r"[\s\u00a0]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def number(c: Column) -> Column:
    """A string of digits as a number; 0 for an empty one."""
    return F.coalesce(F.nullif(c, F.lit("")).try_cast("int"), F.lit(0))


def capture(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, an empty string without one."""
    return F.regexp_extract(c, pattern, group)


def erase(c: Column, *patterns: str) -> Column:
    for pattern in patterns:
        c = F.regexp_replace(c, pattern, "")
    return c


def squeeze(c: Column) -> Column:
    """Single blanks for white space, none at the ends; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), f"{_S}+", " "))

# Heights from which a resolution counts as a quality, and the ranks of qualities.
QUALITY_HEIGHTS = ((1000, "1080p"), (700, "720p"), (460, "480p"), (340, "360p"))
QUALITY_RANK = ("1080p", "720p", "480p", "360p")


def normalise_v1(c: Column) -> Column:
    """Lower case, every run of anything but a-z and 0-9 a blank; other scripts vanish."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def normalise_v2(c: Column) -> Column:
    """Like v1, but letters of every script stay, "&" is "and", apostrophes go and a dot between digits
    stays (T1)."""
    c = F.regexp_replace(F.regexp_replace(F.lower(c), "['’]", ""), "&", " and ")
    c = F.regexp_replace(c, r"([0-9])\.([0-9])", "$1\u0001$2")
    c = F.regexp_replace(c, r"[^\p{L}\p{M}\p{N}\u0001]+", " ")
    return F.trim(F.regexp_replace(c, "\u0001", "."))


def slugify(c: Column) -> Column:
    """Lower case, parentheses as a blank, other characters to single hyphens, none at the ends."""
    c = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\([^\n]*?\)", " ")
    return F.regexp_replace(F.regexp_replace(c, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def make_id(title: Column, year: Column) -> Column:
    """The slug, with the year if it is known (N3); 0 and null are unknown."""
    return F.concat(slugify(title), F.when(F.coalesce(year, F.lit(0)) > 0, F.concat(F.lit("-"), year.cast("string"))).otherwise(""))


def title_case(c: Column) -> Column:
    """The first letter of each word in upper case if it is one of a-z; all else stays."""
    raised = lambda w: F.when(w.rlike("^[a-z]"), F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))).otherwise(w)
    return F.array_join(F.transform(F.split(c, " "), raised), " ")


def path_key(url: Column) -> Column:
    """The path of a URL, or of a link from the site's root, with one slash at its end, whatever the host, query
    and fragment. Null is an empty path."""
    url = F.coalesce(url, F.lit(""))
    path = F.when(url.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), capture(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"))
    path = F.coalesce(path.when(url.startswith("//"), capture(url, "^//[^/?#]*([^?#]*)")).otherwise(capture(url, "^([^?#]*)")), F.lit(""))
    rooted = F.when(path.startswith("/") | (path == ""), path).otherwise(F.concat(F.lit("/"), path))
    return F.concat(F.regexp_replace(_resolved(_encoded(rooted)), "/+$", ""), F.lit("/"))


def _resolved(path: Column) -> Column:
    """A path without "." and ".." parts, which never lead above the root."""
    dot, up = r"(?i)^(?:\.|%2e)$", r"(?i)^(?:\.|%2e){2}$"
    step = lambda out, p: F.when(p.rlike(up), F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).when(p.rlike(dot), out).otherwise(F.concat(out, F.array(p)))
    parts = F.aggregate(F.split(F.substring(path, 2, 1 << 30), "/"), F.array().cast("array<string>"), step)
    return F.when(path.rlike(r"(?i)/(?:\.|%2e)"), F.concat(F.lit("/"), F.array_join(parts, "/"))).otherwise(path)


def _encoded(path: Column) -> Column:
    """A path with the characters that URLs cannot hold as percent-encoded bytes of UTF-8."""
    code = lambda ch: F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1")
    odd = r"[^!#-;=?-Z\[-_a-z|~]"
    return F.when(path.rlike(odd), F.array_join(F.transform(F.split(path, ""), lambda ch: F.when(ch.rlike(odd), code(ch)).otherwise(ch)), "")).otherwise(path)


def canonical_url(url: Column) -> Column:
    """A URL without its query and fragment."""
    return F.regexp_replace(url, "[?#].*$", "")


def absolute_url(link: Column, base: Column) -> Column:
    """A link of a page as an absolute URL: absolute, scheme-relative, from the root, or from the folder."""
    origin = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(canonical_url(base), "^(.*/)[^/]*$", 1)
    return (
        F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(canonical_url(base), link))
        .otherwise(F.concat(F.when(F.length(folder) > F.length(origin) + 1, folder).otherwise(F.concat(origin, F.lit("/"))), link))
    )


def _titled(title: Column, year: Column) -> Column:
    return F.struct(title.alias("title"), year.alias("year"))


def title_from_path(path: Column, site: str = "") -> Column:
    """(title, year) from a path alone (N5): endings by kind of page go, as often as they come; the last year that
    stands between hyphens, else the first one, is the year and goes; then languages and editions at the end.
    `site` is a name that the site adds to its paths."""
    endings = "(?:" + "|".join([f"-tamil-movie-{site}", f"-movie-{site}", *TYPE_ENDINGS, f"-{site}(?:-page)?"] if site else TYPE_ENDINGS) + ")"
    tail = f"(?i)(?:-(?:{LANGUAGES}|{EDITIONS})+)+\\z"
    apart, anywhere = f"^(.*)(?:^|-)({YEAR})(?=-|\\z)(.*)\\z", f"^(.*?)({YEAR})(.*)\\z"

    def rest(s: Column) -> Column:
        bare = F.when(s.rlike(apart), F.regexp_replace(s, apart, "$1-$3")).otherwise(F.regexp_replace(s, anywhere, "$1-$3"))
        bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, f"{_S}+", "-"), "-{2,}", "-"), "^-+|-+$", "")
        bare = erase(bare, f"{endings}+\\z", tail)
        year = F.when(s.rlike(apart), capture(s, apart, 2)).otherwise(capture(s, anywhere, 2))
        return _titled(title_case(squeeze(F.regexp_replace(bare, "[-_]+", " "))), number(year))

    return let(erase(F.regexp_replace(path_key(path), "^/+|/+$", ""), f"{endings}\\z"), rest)


def clean_title(label: Column, path: Column, site: str = "") -> Column:
    """(title, year) of a label (N6): all up to a year in brackets, else without a bare year; brackets with noise,
    noise words, languages and editions at the end go, and a last dash. Without a title, the path's."""
    bracket = r"\(((?:19|20)[0-9]{2})\)"
    bare = f"{_S}({YEAR})(?:{_S}|\\z)"

    def rest(s: Column) -> Column:
        in_brackets = number(capture(s, bracket))
        year = F.when(in_brackets > 0, in_brackets).otherwise(number(capture(s, bare)))
        t = F.when(in_brackets > 0, F.trim(F.regexp_replace(s, f"{bracket}.*\\z", ""))).otherwise(F.trim(F.regexp_replace(s, f"^(.*?){bare}", "$1 ")))
        t = F.trim(erase(t, f"(?i)(?:{_S}*\\((?=[^)]*(?:{BRACKET_NOISE}))[^)]*\\){_S}*)+\\z"))
        t = F.trim(erase(t, f"(?i)(?:{_S}*\\b(?:{WORD_NOISE})\\b{_S}*)+\\z"))
        t = erase(t, f"(?i)(?:{_S}+(?:{LANGUAGES}|{EDITIONS}|dvdr))+\\z")
        return _titled(F.trim(erase(t, f"{_S}*[-\u2013]{_S}*\\z")), year)

    found = let(squeeze(label), rest)
    return let(F.struct(found.alias("own"), title_from_path(path, site).alias("path")), lambda x: F.when(x["own"]["title"] == "", x["path"]).otherwise(x["own"]))


def title_for(label: Column, path: Column, site: str = "") -> Column:
    """The final (title, year) of a listed item, null for junk (N7): the label's, unless it is generic or only the
    path has a year and the label is no richer than the path."""

    def rest(x: Column) -> Column:
        own, path_ = x["own"], x["path"]
        usable = (own["title"] != "") & ~own["title"].rlike(GENERIC_LABEL) & ~own["title"].startswith("(")
        words = lambda c: F.size(F.split(c, " "))
        richer = usable & (own["title"].rlike(r"[()\[\].:]") | (words(own["title"]) > words(path_["title"])))
        year = F.when(usable, own["year"]).otherwise(0)
        from_path = (year == 0) & (path_["year"] > 0)
        first = F.when(usable, own["title"]).otherwise(path_["title"])
        title = F.when(from_path & ~richer & (path_["title"] != ""), path_["title"]).otherwise(first)
        return _titled(title, F.when(from_path, path_["year"]).otherwise(year))

    found = let(F.struct(clean_title(label, path, site).alias("own"), title_from_path(path, site).alias("path")), rest)
    return let(found, lambda t: F.when((t["title"] != "") & (slugify(t["title"]) != ""), t))


def season_of(c: Column) -> Column:
    """The number after "season", 0 without one."""
    return number(capture(c, "(?i)season[- ]?0*([0-9]+)"))


def episode_of(c: Column) -> Column:
    """The number after "epi", "ep" or "episode", 0 without one."""
    return number(capture(c, "(?i)(?:epi|ep|episode)[- ]?0*([0-9]+)"))


def parse_label(label: Column, path: Column, folder: str = "/movie/") -> Column:
    """(title, year, is_series, season) of a label such as "Name (2020) Season 3 (Epi 9)" (N8). The slug below
    `folder` fills a missing title or year, its last year being the release's."""
    year_words = f"(?i){_S}*\\({_S}*(?:19|20)[0-9]{{2}}{_S}*\\).*\\z"
    slug_year = "^(.*)-((?:19|20)[0-9]{2})(?=-|\\z)(.*)\\z"

    def named(x: Column) -> Column:
        t, p = x["text"], x["path"]
        title = F.trim(erase(t, year_words, f"(?i){_S}*[-(]?{_S}*tamil{_S}+dubbed.*\\z", f"(?i){_S}+tamil{_S}*\\z", f"{_S}*[\\[(].*\\z", r"[\s\u00a0\u00b7-]+\z"))
        bracketed = number(capture(t, r"\(((?:19|20)[0-9]{2})\)"))
        year = F.when(bracketed > 0, bracketed).otherwise(number(capture(t, r"(?<![0-9A-Za-z_])((?:19|20)[0-9]{2})(?![0-9A-Za-z_])")))
        return F.struct(title.alias("title"), year.alias("year"), (t.rlike(r"(?i)web series|season\s*[0-9]") | p.contains("-web-series/")).alias("series"), season_of(t).alias("season"), erase(p, f"^{folder}", "/\\z").alias("slug"))

    def filled_(x: Column) -> Column:
        gap = (x["title"] == "") | (x["year"] == 0)
        base = F.when(x["slug"].rlike(slug_year), capture(x["slug"], slug_year)).otherwise(x["slug"])
        base = erase(base, "(?i)(?:-(?:tamil|english|hindi|kannada|telugu|malayalam)-?(?:dubbed)?|-(?:dubbed|web-series|web|hd|original|collections?))\\z")
        from_slug = title_case(F.regexp_replace(base, "-", " "))
        slug_season = number(capture(capture(x["slug"], slug_year, 3), "(?i)season[- ]?([0-9]+)"))
        title = F.when(x["title"] == "", F.trim(from_slug)).otherwise(x["title"])
        year = F.when(gap & (x["year"] == 0), number(capture(x["slug"], slug_year, 2))).otherwise(x["year"])
        season = F.when(gap & (x["season"] == 0), slug_season).otherwise(x["season"])
        return F.struct(title.alias("title"), year.alias("year"), (x["series"] | (gap & (slug_season > 0))).alias("is_series"), season.alias("season"))

    def bare(x: Column) -> Column:
        t = erase(x["title"], f"(?i){_S}*[-\u2013:\u2014]?{_S}*(?:episode|epi)\\.?{_S}*[0-9]+{_S}*(?:[-\u2013:\u2014].*)?\\z", f"(?i){_S}*[-\u2013:]?{_S}*season{_S}*[0-9]+{_S}+(?:e|ep|epi|episode)[- .]?{_S}*[0-9]+.*\\z", f"(?i){_S}*[-\u2013:]?{_S}*season{_S}*[0-9]+{_S}*(?:part{_S}*[0-9]+)?{_S}*\\z")
        t = F.regexp_replace(t, f"(?i){_S}+tamil(?={_S}+(?:season|part)\\b|{_S}*\\z)", " ")
        numbered = (x["season"] > 0) | x["title"].rlike(r"(?i)\b(?:epi|episode)\b")
        return F.struct(F.when(numbered, F.trim(erase(t, r"[\s\u00a0\u00b7-]+\z"))).otherwise(x["title"]).alias("title"), x["year"].alias("year"), x["is_series"].alias("is_series"), x["season"].alias("season"))

    return let(let(let(F.struct(squeeze(label).alias("text"), F.coalesce(path, F.lit("")).alias("path")), named), filled_), bare)


def twin_base(title: Column) -> Column:
    """A title without seasons, parts, volumes and years: what twins have in common."""
    t = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"\b(?:season|part|vol|volume)\s*[0-9]+\b", " ")
    return normalise_v1(F.regexp_replace(t, r"\b(?:19|20)[0-9]{2}\b", " "))


def display_name(title: Column, year: Column) -> Column:
    """"title (year)", the year if it is known."""
    return F.concat(title, F.when(F.coalesce(year, F.lit(0)) > 0, F.concat(F.lit(" ("), year.cast("string"), F.lit(")"))).otherwise(""))


def until(hours: Column) -> Column:
    """How long until a time, as a log says it."""
    h = F.floor(hours + 0.5)
    days = F.floor(h / 24 + 0.5)
    return F.when(h < 1, "<1h").when(h < 48, F.concat(h.cast("string"), F.lit("h"))).otherwise(F.concat(days.cast("string"), F.lit("d")))


def clock(ms: Column) -> Column:
    """A duration as a log says it."""
    return F.when(ms < 1000, F.concat(ms.cast("long").cast("string"), F.lit("ms"))).when(ms < 60_000, F.concat(F.format_string("%.1f", ms / 1000.0), F.lit("s"))).otherwise(F.concat(F.floor(ms / 60_000 + 0.5).cast("string"), F.lit("m")))


def family(reason: Column) -> Column:
    """A skip reason without its times."""
    return F.regexp_replace(reason, " \u00b7 (?:refresh|retry) in .*$", "")


def quality_of(label: Column, link: Column, default: str = "HD") -> Column:
    """The quality that a link names (N9); a site that labels pictures by size is covered by `sized_quality`."""
    q = F.lower(capture(F.concat_ws(" ", label, link), "(?i)(1080p|720p|480p|360p)"))
    return F.when(q == "", default).otherwise(q)


def sized_quality(label: Column, link: Column) -> Column:
    """The quality that a link names, else by the height in "640x360", else empty."""
    t = F.concat_ws(" ", label, link)
    q, h = F.lower(capture(t, "(?i)(1080p|720p|480p|360p|240p)")), number(capture(t, "[0-9]{3,4}\\s*[x*\u00d7X]\\s*([0-9]{3,4})"))
    by_height = F.when(h == 0, "").when(h < QUALITY_HEIGHTS[-1][0], F.concat(h.cast("string"), F.lit("p"))).otherwise(quality_bucket(h))
    return F.when(q != "", q).otherwise(by_height)


def quality_bucket(height: Column) -> Column:
    """Quality by height of the picture."""
    out = F.when(F.lit(False), "")
    for least, name in QUALITY_HEIGHTS:
        out = out.when(height >= least, name)
    return out.otherwise("other")


def quality_rank(quality: Column) -> Column:
    """Sort key of a quality, better ones first (O1)."""
    out = F.when(F.lit(False), 0)
    for k, name in enumerate(QUALITY_RANK):
        out = out.when(quality == name, k)
    return out.otherwise(len(QUALITY_RANK))


def fingerprint(*columns: Column) -> Column:
    """First 20 hexadecimal digits of the SHA-256 of the fields, nulls as empty, joined by bars."""
    return F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)).cast("binary"), 256), 1, 20)


def split_credits(c: Column, most: int = 8) -> Column:
    """Names from a list with commas or "and": trimmed, distinct in order, no empty ones or n/a."""
    names = F.transform(F.split(F.coalesce(c, F.lit("")), r",|\s+and\s+"), lambda x: F.trim(x))
    return F.slice(F.array_distinct(F.filter(names, lambda x: (x != "") & ~x.rlike(r"(?i)^(?:n/?a|unknown|none|not available)\z"))), 1, most)


# Values of Roman digits, number words, and words that a single Roman digit counts a part after.
ROMAN = (("i", 1), ("v", 5), ("x", 10), ("l", 50), ("c", 100), ("d", 500), ("m", 1000))
NUMBER_WORDS = ("two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty")
PART_WORDS = ("part", "chapter", "volume", "vol", "season", "episode", "book", "act")


def roman(token: Column) -> Column:
    """The value of a Roman numeral in lower case, null for what is none."""
    value = F.create_map(*(F.lit(x) for pair in ROMAN for x in pair))
    digits = F.transform(F.split(token, ""), lambda ch: F.coalesce(value[ch], F.lit(0)))
    total = let(digits, lambda d: F.aggregate(F.transform(d, lambda x, i: F.when(x < F.coalesce(F.get(d, i + 1), F.lit(0)), -x).otherwise(x)), F.lit(0), lambda n, x: n + x))
    return F.when(token.rlike("^(?=.)m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})$"), total)


def numeral(c: Column) -> Column:
    """A title's Roman and spelled numerals as digits, word by word, so that sequels compare alike (T2). After a word like "part" every
    Roman numeral counts; elsewhere "v" and those of i, v and x with two digits or more, for "mix" and "I" are mostly words."""
    words = F.create_map(*(F.lit(x) for k, w in enumerate(NUMBER_WORDS, 2) for x in (w, str(k))))

    def word(w: Column, before: Column) -> Column:
        counted = F.coalesce(before.isin(*PART_WORDS), F.lit(False)) | w.rlike("^(?:v|[ivx]{2,})$")
        return F.coalesce(words[w], F.when(counted, roman(w).cast("string")), w)

    each = lambda t: F.transform(t, lambda w, i: word(w, F.when(i > 0, F.get(t, i - 1))))
    return F.array_join(let(F.split(c, " "), each), " ")


def title_similarity(a: Column, b: Column, least: int = 8) -> Column:
    """1 for titles that are equal once normalised; 0 if their numbers differ or a fuzzy match would be of
    a short title; else one minus the edit distance over the longer length (T2)."""
    a, b = numeral(normalise_v2(a)), numeral(normalise_v2(b))
    digits = lambda c: F.regexp_replace(F.regexp_replace(c, "[^0-9]+", " "), "^ | $", "")
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(a == b, 1.0).when((digits(a) != digits(b)) | (F.least(F.length(a), F.length(b)) < least), 0.0).otherwise(1 - F.levenshtein(a, b) / longer)


def retryable(status: Column) -> Column:
    """Whether an HTTP status is worth another try (S11): 408, 429 and what is not 4xx or fine."""
    return F.when(status.between(200, 399), "ok").when(status.isin(408, 429) | ~status.between(400, 499), "retry").otherwise("fail")
