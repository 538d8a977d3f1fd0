"""The keyword rules as Column expressions: decision lists over the cues found in the lower-cased text."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType


def _cues(s: str) -> tuple[str, ...]:
    return tuple(sorted(s.split("|")))


PROBLEM = _cues(
    "struggling|stuck|should i|recommend|problem|need|looking for|issue|how to|how do i|help|glitch|frustrated"
    "|failure|failing|fails|failed|fail|error|cannot|can't|bug|broken|anyone else"
)
#: Phrase -> the cues that it takes out, wherever they stand.
NEGATED = {
    phrase: tuple(cues.split())
    for cues, phrases in {
        "problem": "no problem|no problems|not a problem",
        "issue": "never an issue|no issue|no issues|not an issue|without issue|without issues",
        "broken": "no longer broken|not broken",
        "bug": "no bug|no bugs",
        "fail": "without fail",
        "fail failed": "never failed",
        "fail fails": "never fails",
        "fail failing": "never failing",
        "fail failure": "never failure",
    }.items()
    for phrase in phrases.split("|")
}
RESOLVED = _cues(
    "was able to fix it by|turns out it was|solved this by|solved it by|randomly got|it was resolved when|issue was resolved when"
    "|i fixed this by|i fixed it by|fixed this by|fixed it by|finally solved|ended up fixing it by|already fixed"
)
#: Two cues of each list hold this in place of "'s", as the rules have them; no real text does.
ODD = "here'" + "studio "
ADVICE = _cues(f"workflow|walkthrough|tutorial|tips and tricks|tips|playbook|lessons learned|i learned|how i|here is how i|{ODD}my advice|{ODD}how i|guide")
CONTEXT = _cues(
    "worked for me|wanted to share|the solution was|solved this by|solved it by|solution:|sharing my experience|my solution"
    f"|in case it helps|i solved|i fixed|hope this helps|here is what worked|here is what i did|{ODD}what worked|{ODD}what i did"
    "|for anyone else|fixed this by|fixed it by|fix was"
)
SOFTWARE = _cues("update|tool|software|settings|script|program|install|error|driver|crash|config|code|bug|automation|application|app|api")
HARDWARE = _cues(
    "warranty|replacement|recommend a|purchase|printer|power supply|motherboard|looking for a|job|hardware|graphics card|gpu"
    "|firmware|education|device|cpu|course|class|career|camera|buy|alternative"
)
EXTERNAL = _cues(
    "which should i|warranty|vevor|vendor|toshiba|support|supplier|store|sony|school|samsung|rma|retailer|replacement|repair"
    "|recommend a|recommend|quote|purchase a|purchase|printer|msi|microsoft|manufacturer|looking to buy|lg|lenovo|job|hp|hardware"
    "|goxlr|estimate|device|dell|dealer|customer service|college|career|buying|buy new|buy a|buy|asus|apple|alternative|acer"
)
PROTOTYPE = _cues("sensor|prototype|manufacturing|deployment")
QUESTION = _cues("who knows|what should i|is there a way|how to|how do i|does anyone|could someone|can anyone|anyone know")
UNSURE = _cues("probably|perhaps|not sure|maybe|i think|i guess")
SHOWCASE = _cues("showcase|launch|i made|i built")
LEARNING = _cues("how to|how do i")
PRODUCT = _cues("tool|software|program|application|app")
MAKING = _cues("develop|create|build")
STUDY = _cues("school|college|career")

FIELDS = tuple("intent is_problem is_software_solvable is_external problem_reason software_reason external_reason detected_patterns confidence".split())
LABELS = FIELDS[:4]
INTENTS = dict(discussing="4", showcasing="3", sharing_advice="2", seeking_help="1")


YES, NO = "1", "0"


#: Every cue and phrase that is looked for, by number.
_GROUPS = (
    PROBLEM, tuple(NEGATED), RESOLVED, ADVICE, CONTEXT, SOFTWARE, HARDWARE, EXTERNAL, PROTOTYPE, QUESTION, UNSURE, SHOWCASE,
    LEARNING, PRODUCT, MAKING, STUDY, ("?", "looking for", "which", "should i", "advice"),
)
CUES = tuple(dict.fromkeys(c for group in _GROUPS for c in group))
NUMBER = {c: k for k, c in enumerate(CUES)}
#: Bits of a long that are used; words whose cues a worker remembers, and their greatest length.
WIDTH, MEMO, LONGEST = 62, 1 << 18, 40


class Finder:
    """The cues of a text as bits. A cue without white space stands within a word, and words come again and again, so
    their bits are kept; a cue of several words is looked for only where a word ends with its first and one begins with its last.
    """

    def __init__(self):
        split = lambda c: any(map(str.isspace, c))
        whole = [c for c in CUES if split(c)]
        ends = {e: 1 << (len(CUES) + k) for k, e in enumerate(sorted({c.split()[0] + "\n" for c in whole} | {"\n" + c.split()[-1] for c in whole}))}
        #: What words between line ends are searched for: cues, last parts of a word, first parts of a word.
        self.parts = [(c, 1 << NUMBER[c]) for c in CUES if not split(c)] + list(ends.items())
        self.whole = [(c, ends[c.split()[0] + "\n"] | ends["\n" + c.split()[-1]], 1 << NUMBER[c]) for c in whole]
        self.memo: dict[str, int] = {}

    def learn(self, words: list[str]) -> int:
        """The bits of words together, and those of each word for later texts."""
        lines = "\n" + "\n".join(words) + "\n"
        met = [(p, v) for p, v in self.parts if p in lines]
        if len(self.memo) >= MEMO:
            self.memo.clear()
        for w in words:
            if len(w) <= LONGEST:
                line = f"\n{w}\n"
                self.memo[w] = sum(v for p, v in met if p in line)
        return sum(v for _, v in met)

    def __call__(self, text: str) -> int:
        found, get, new = 0, self.memo.get, []
        for w in set(text.split()):
            bits = get(w)
            if bits is None:
                new.append(w)
            else:
                found |= bits
        if new:
            found |= self.learn(new)
        for c, ends, v in self.whole:
            if found & ends == ends and c in text:
                found |= v
        return found


_finder: list[Finder] = []


@F.arrow_udf(ArrayType(LongType()))
def cues(texts: pa.Array) -> pa.Array:
    """Which of CUES are in each text (in lower case): bits in longs of WIDTH bits."""
    if not _finder:
        _finder.append(Finder())
    find, n, full = _finder[0], -(-len(CUES) // WIDTH), (1 << WIDTH) - 1
    return pa.array([[f >> (WIDTH * k) & full for k in range(n)] for f in map(find, texts.to_pylist())], pa.list_(pa.int64()))


def has(found: Column, wanted: tuple[str, ...]) -> Column:
    """Whether any of the wanted cues is among those found by ``cues``."""
    masks: dict[int, int] = {}
    for c in wanted:
        masks[NUMBER[c] // WIDTH] = masks.get(NUMBER[c] // WIDTH, 0) | 1 << (NUMBER[c] % WIDTH)
    return reduce(lambda a, b: a | b, [found[k].bitwiseAND(F.lit(m)) != 0 for k, m in sorted(masks.items())])


def hits(found: Column, wanted: tuple[str, ...]) -> Column:
    """The wanted cues among those found, in their order."""
    return F.array_compact(F.array(*[F.when(has(found, (c,)), F.lit(c)) for c in wanted]))


def _three(found: Column) -> Column:
    return F.array_join(F.slice(found, 1, 3), ", ")


def _decide(*branches: tuple[Column, str, Column | str], last: tuple[str, str]) -> tuple[Column, Column]:
    """A decision list: the label and the reason of the first branch that holds."""
    label, reason = None, None
    for test, value, why in branches:
        why = F.lit(why) if isinstance(why, str) else why
        label = F.when(test, value) if label is None else label.when(test, value)
        reason = F.when(test, why) if reason is None else reason.when(test, why)
    return label.otherwise(last[0]), reason.otherwise(last[1])


def intent(t: Column) -> Column:
    k = INTENTS
    return (
        F.when(has(t, ("?",)) | has(t, QUESTION), k["seeking_help"])
        .when(has(t, ADVICE) | has(t, RESOLVED) | has(t, CONTEXT), k["sharing_advice"])
        .when(has(t, SHOWCASE), k["showcasing"])
        .when(has(t, PROBLEM), k["seeking_help"])
        .otherwise(k["discussing"])
    )


def open_cues(t: Column, found: Column) -> Column:
    """Problem cues without those that a negated phrase takes out."""
    blocked = F.flatten(F.array(*[F.when(has(t, (p,)), F.array(*[F.lit(c) for c in cues])).otherwise(F.array().cast("array<string>")) for p, cues in NEGATED.items()]))
    return F.array_except(found, blocked)


def problem(t: Column, intent_: Column) -> tuple[Column, Column]:
    found = hits(t, PROBLEM)
    left = open_cues(t, found)
    return _decide(
        (has(t, RESOLVED), NO, "Story explains how the issue was already resolved."),
        ((intent_ == "3") & (F.size(found) == 0), NO, "Showcase post without any unresolved frustration."),
        (F.size(left) > 0, YES, F.concat(F.lit("Found unresolved problem cues: "), _three(left), F.lit("."))),
        (F.size(found) > 0, NO, "Problem words only show up in negated phrases."),
        (intent_ == "2", YES, "Post shares advice based on a real past problem."),
        last=(NO, "No unresolved problem indicators detected."),
    )


def software(t: Column, is_problem: Column) -> tuple[Column, Column]:
    soft, hard = hits(t, SOFTWARE), hits(t, HARDWARE)
    s, h = F.size(soft) > 0, F.size(hard) > 0
    return _decide(
        (is_problem != "1", NO, "No active problem, so this label stays at 0."),
        (has(t, ("looking for",)) & has(t, PRODUCT) & ~has(t, MAKING), NO, "Looking for an existing product rather than fixing software."),
        (s & ~h, YES, F.concat(F.lit("Clear software troubleshooting cues: "), _three(soft), F.lit("."))),
        (h & ~s, NO, F.concat(F.lit("Signals point to hardware or market research ("), _three(hard), F.lit(")."))),
        (has(t, LEARNING), NO, "Question is about learning, not repairing software."),
        (has(t, ("driver", "update")), YES, "Mentions drivers or updates linking problem to software."),
        (s & h, NO, "Mix of hardware and product cues, " "so not purely software solvable."),
        last=(NO, "No strong software-related clues detected."),
    )


def external(t: Column, is_problem: Column) -> tuple[Column, Column]:
    advice = has(t, ("advice",))
    found = hits(t, EXTERNAL)
    return _decide(
        (is_problem != "1", NO, "No active problem, so this label stays at 0."),
        (has(t, ("which",)) & has(t, ("should i",)), YES, "Choosing between outside options, so external help is needed."),
        (has(t, ("job",)) & advice, NO, "Career advice discussion can be handled individually."),
        (has(t, STUDY) & advice, NO, "Education or career advice does not need outside partners."),
        (F.size(found) > 0, YES, F.concat(F.lit("Needs outside support: "), _three(found), F.lit("."))),
        (has(t, PROTOTYPE), YES, "Prototype work calls for external hardware or fabrication help."),
        (has(t, LEARNING), NO, "User can act alone with the right guidance."),
        last=(NO, "No signs that external coordination is required."),
    )


def patterns(t: Column) -> Column:
    return F.array_compact(
        F.array(
            F.when(has(t, LEARNING), "learning_question"),
            F.when(has(t, ("looking for",)), "seeking_existing_solution"),
            F.when(has(t, ADVICE), "advice_sharing"),
            F.when(has(t, RESOLVED), "resolved_problem"),
        )
    )


def confidence(t: Column, tags: Column) -> Column:
    return F.when(has(t, UNSURE), 0.3).when(F.size(tags) > 0, 0.7).otherwise(1.0)


def classify(df, text: Column, prefix: str = ""):
    """``df`` with the nine fields of the rules over ``text``; null counts as ''. Texts are searched once."""
    p = lambda n: prefix + n
    df = df.withColumn("__t", cues(F.lower(F.coalesce(text, F.lit("")))))
    t = F.col("__t")
    df = df.withColumn(p("intent"), intent(t))
    label, why = problem(t, F.col(p("intent")))
    df = df.withColumns({p("is_problem"): label, p("problem_reason"): why})
    (s, sw), (e, ew) = software(t, F.col(p("is_problem"))), external(t, F.col(p("is_problem")))
    tags = patterns(t)
    return df.withColumns(
        {
            p("is_software_solvable"): s, p("software_reason"): sw, p("is_external"): e, p("external_reason"): ew,
            p("detected_patterns"): F.array_join(tags, ", "), p("confidence"): confidence(t, tags),
        }
    ).drop("__t")


def valid(row: Column | None = None) -> Column:
    """Whether the nine fields fit the schema: eight strings, known labels not empty, and a number."""
    strings = [F.col(f) for f in FIELDS[:8]]
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in strings] + [F.col("confidence").isNotNull()])
