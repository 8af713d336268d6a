"""SQL expressions the checks share (DuckDB)."""

HIDDEN = r"<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
MARKUP = rf"(?is){HIDDEN}|<[a-z/!?][^>]*>"
HEADERS = (r"^(?:The|And|Of|La|Der)\s",)
LINK_BASE = "https://pages.example.org"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def words(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')"


def normalize(x: str) -> str:
    x = f"regexp_replace({x}, '[,:;''.!?]', '', 'g')"
    for numeral, digit in (("IX", 9), ("VIII", 8), ("VII", 7), ("VI", 6), ("IV", 4), ("III", 3), ("II", 2)):
        x = f"replace({x}, '{numeral}', '{digit}')"
    split = rf"string_split(regexp_replace({x}, '[\s_-]+', ' ', 'g'), ' ')"
    return f"array_to_string(list_transform({split}, lambda w: CASE WHEN w[1:1] = 'ß' THEN 'Ss' ELSE upper(w[1:1]) END || lower(w[2:])), ' ')"


def entities(x: str) -> str:
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·"), ("nbsp", " "), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{char}')"
    return x


def strip_markup(x: str) -> str:
    return entities(f"regexp_replace({x}, '{MARKUP}', '', 'g')")


def paragraphs(x: str) -> str:
    body = rf"regexp_replace({x}, '(?is){HIDDEN}|<table\b.*?</table\s*>', '', 'g')"
    cut = r"regexp_replace(b, '(?is)</p\s*>.*$', '')"
    return (rf"list_transform(string_split_regex({body}, '(?i)<p\b[^>]*>')[2:], "
            f"lambda b: {strip(strip_markup(cut))})")


def first_long_paragraph(x: str) -> str:
    return f"list_filter({paragraphs(x)}, lambda p: length(p) > 30)[1]"


def segments(x: str) -> str:
    pattern = "(?im)(" + "|".join(f"{h}.*?$" for h in HEADERS) + ")"
    split = rf"string_split(regexp_replace({x}, '{pattern}', chr(1) || '\1', 'g'), chr(1))"
    return f"list_transform({split}, lambda s: {strip('s')})"


LINKS = rf"""
  blocks AS (SELECT page_id, regexp_extract(regexp_replace(html, '(?is){HIDDEN}', '', 'g'), '(?is)<ul\b[^>]*>(.*?)</ul\s*>', 1) AS block FROM pages),
  anchors AS (SELECT page_id, generate_subscripts(a, 1) - 1 AS i, unnest(a) AS a
              FROM (SELECT page_id, regexp_extract_all(block, '(?is)<a\b[^>]*>.*?</a\s*>') AS a FROM blocks)),
  hrefs AS (SELECT page_id, i, {strip(strip_markup('a'))} AS name,
                   {entities("regexp_extract(a, '(?is)^<a[^>]*?href[ ]*=[ ]*\"([^\"]*)\"', 1)")} AS href FROM anchors),
  links AS (SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::int AS position, name,
                   CASE WHEN starts_with(href, 'http') THEN href ELSE '{LINK_BASE}' || href END AS url
            FROM hrefs WHERE href <> '')"""


def hashed(table: str, keys: str, text: str, name: str) -> str:
    """CTEs for the word-hashing vectors of a text column, as (keys, bucket, weight)."""
    return f"""
  {name}_words AS (SELECT {keys}, unnest({words(f'lower({text})')}) AS w FROM {table}),
  {name}_counts AS (SELECT {keys}, ('0x' || substr(md5(w), 1, 8))::bigint % 64 AS bucket, count(*)::double AS c
                    FROM {name}_words GROUP BY ALL),
  {name}_norms AS (SELECT {keys}, sqrt(sum(c * c)) AS norm FROM {name}_counts GROUP BY ALL),
  {name} AS (SELECT {keys}, bucket::int AS bucket, floor(1e3 * c / norm + 0.5)::int AS weight
             FROM {name}_counts JOIN {name}_norms USING ({keys}))"""
