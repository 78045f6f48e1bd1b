"""Comment lexicons, kept as data: one entry per (language, pattern text).

Fixed values: the regex alternatives below must equal the reference's word
lists for identical classification. They are stated as written there, in
the same order, grouped by the language the reference names; do not edit
them without re-running the golden phrase table in
``tests/test_signal.py``.

``FULL_*`` is the Spark job's lexicon (applied with Java ``(?i)``: ASCII-only
case folding). ``SHORT_*`` is the smaller lexicon of the local enrichment
script, whose Python ``re`` folds Unicode case.
"""

from __future__ import annotations

# --- Fixed values: full lexicon, positive (demolition) signal ---------------
FULL_POSITIVE: tuple[tuple[str, str], ...] = (
    ("English",
     r"demolish\w*|destroy\w*|destruct\w*|"
     r"raze[ds]?|"
     r"torn\s+down|knock\w*\s+down|tear\w*\s+down|pulled\s+down|"
     r"burned?\s+down|burnt\s+down|"
     r"no\s+longer\s+exists?|"
     r"\bremoved\b|\bgone\b|ceased|dismantled|leveled|vacated"),
    ("Spanish",
     r"demolid[oa]s?|demolici[oó]n|"
     r"destruid[oa]s?|"
     r"derribad[oa]s?|tumbad[oa]s?|"
     r"removid[oa]s?|eliminad[oa]s?|"
     r"ya\s+no\s+(existe|esta|está)|"
     r"desaparecid[oa]s?|escombros"),
    ("Portuguese",
     r"demolid[oa]s?|destru[ií]d[oa]s?|derrubad[oa]s?|"
     r"n[aã]o\s+existe\s+mais|desapareceu|demoli[çc][aã]o"),
    ("French",
     r"d[ée]moli[es]?|d[ée]molition|"
     r"d[ée]truit[es]?|abattu[es]?|supprim[ée]s?|ras[ée]s?|"
     r"n[''’]existe\s+plus|disparu[es]?"),
    ("German",
     r"abgerissen|zerst[öo]rt|demoliert|entfernt|"
     r"abgebaut|abgebrochen|niedergerissen|"
     r"existiert\s+nicht\s+mehr|verschwunden"),
    ("Italian",
     r"demolit[oaie]|distrutt[oaie]|abbattut[oaie]|rimoss[oaie]|"
     r"demolizione|non\s+esiste\s+pi[ùu]|scompars[oaie]"),
    ("Polish",
     r"zburzon[ya]|zniszczon[ya]|wyburzon[ya]|rozebran[ya]|"
     r"usuni[ęe]t[ya]|nie\s+istnieje"),
    ("Dutch",
     r"gesloopt|vernietigd|verwijderd|bestaat\s+niet\s+meer|weggehaald"),
    ("Swedish / Norwegian / Danish",
     r"\brivet\b|\brevet\b|nedrivet|fjernet|"
     r"\b[öo]delagd\b|eksisterer\s+ikke"),
    ("Czech",
     r"zbouran[oýa]|zni[čc]en[ýa]|odstran[ěe]n[ýa]"),
    ("Turkish",
     r"y[ıi]k[ıi]ld[ıi]|y[ıi]k[ıi]lm[ıi][şs]|kald[ıi]r[ıi]ld[ıi]|"
     r"mevcut\s+de[ğg]il"),
    ("Russian",
     r"снес[её]н[аоы]?|разрушен[аоы]?|удал[её]н[аоы]?|"
     r"уничтожен[аоы]?|не\s+существует|снесли|разобрали"),
    ("Greek",
     r"κατεδαφ[ιί]στηκε|καταστρ[άα]φηκε|αφαιρ[έε]θηκε"),
    ("Hebrew",
     r"נהרס[ה]?|נהרסת|פורק|הוסר"),
    ("Arabic",
     r"هدم|تم\s+هدم|دم[ّر]|أزيل|أزيلت|تمت\s+إزالة"),
    ("Persian",
     r"تخریب|تخریب\s+شد|حذف\s+شد"),
    ("Hindi",
     r"ध्वस्त|नष्ट|हटाया"),
    ("Chinese",
     r"拆除|拆[毁卸燬]|摧[毁燬]|不存在|已拆|被拆|消失|清拆"),
    ("Japanese",
     r"取り壊|解体|撤去|存在しない|消失"),
    ("Korean",
     r"철거|파괴|제거됨|존재하지\s*않"),
)

# --- Fixed values: full lexicon, negative (exclude) signal ------------------
# A bare "import" (as in "fix import error") is deliberately not negative.
FULL_NEGATIVE: tuple[tuple[str, str], ...] = (
    ("English",
     r"\brevert\w*|"
     r"vandal\w*|"
     r"\bundo\b|undone|"
     r"\btest\b|"
     r"\btiger\b|"
     r"mass\s+import|automated\s+import|bulk\s+import|"
     r"automated|\bbot\s+(edit|import|fix)|"
     r"duplicate|deduplicate|"
     r"\bmistake\b|by\s+mistake|"
     r"\bwrong\b|incorrect"),
    ("Spanish",
     r"vandalismo|prueba|"
     r"duplicad[oa]s?|por\s+error|incorrecto"),
    ("Portuguese",
     r"vandalismo|duplicad[oa]s?|por\s+erro"),
    ("French",
     r"vandalisme|annul[ée]s?|doublon|par\s+erreur"),
    ("German",
     r"vandalismus|doppelt|aus\s+versehen"),
    ("Italian",
     r"vandalismo|duplicato|per\s+errore"),
    ("Russian",
     r"вандализм|откат|отменено|дубликат|по\s+ошибке"),
    ("Chinese / Japanese",
     r"撤回|恢复|破坏|测试|重复|错误|"
     r"取り消し|破壊|テスト"),
)

# --- Fixed values: short lexicon (local script; English/Spanish/Portuguese) --
SHORT_POSITIVE: tuple[tuple[str, str], ...] = (
    ("English / Spanish / Portuguese",
     r"demolish|demolido|demolida|demolicion|demolição|"
     r"destroy|destruct|destruido|destruída|destruída|"
     r"raze|razed|"
     r"torn\s*down|burned?\s*down|"
     r"no\s*longer\s*exists?|no\s*existe|"
     r"ya\s*no\s*(existe|esta|está)|"
     r"não\s*existe\s*mais|"
     r"removed|removido|removida|"
     r"derribad[oa]|tumbad[oa]|"
     r"eliminad[oa]"),
)

SHORT_NEGATIVE: tuple[tuple[str, str], ...] = (
    ("English / Spanish / Portuguese",
     r"revert|reverted|reverting|"
     r"vandal|vandalism|vandalismo|"
     r"undo|undone|deshacer|"
     r"\btest\b|prueba|"
     r"import|imported|importacion|"
     r"\btiger\b|"
     r"duplicate|duplicado|duplicada|"
     r"mistake|by\s*mistake|por\s*error|"
     r"\bwrong\b|incorrecto|"
     r"\bbot\b|automated"),
)

LEXICONS = {
    "full": (FULL_NEGATIVE, FULL_POSITIVE),
    "short": (SHORT_NEGATIVE, SHORT_POSITIVE),
}


def alternation(groups: tuple[tuple[str, str], ...]) -> str:
    """All groups as one capture group of alternatives, without flags."""
    return "(" + "|".join(text for _, text in groups) + ")"
