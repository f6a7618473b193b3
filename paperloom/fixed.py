"""Fixed values of the document formats that the engine reads: names, markers, headings, labels, word lists, thresholds.

They are facts about the corpus, not logic, and stand here together; operators take them as defaults."""

# Subjects with folder, names, coefficient, hours and kind of processing.
SUBJECT_ROWS = (
    ("svt", "svt", "علوم الطبيعة والحياة", "Sciences de la Vie et de la Terre", 6, 4.5, "full"),
    ("physic", "physic", "العلوم الفيزيائية", "Sciences Physiques", 5, 3.5, "full"),
    ("math", "Math", "الرياضيات", "Mathématiques", 5, 3.5, "full"),
    ("arabe", "arabe", "اللغة العربية وآدابها", "Langue et Littérature Arabes", 3, 2.5, "rag_only"),
    ("islamic", "Islamic", "العلوم الإسلامية", "Sciences Islamiques", 2, 2.5, "rag_only"),
    ("francais", "francais", "اللغة الفرنسية", "Langue Française", 2, 2.5, "rag_only"),
    ("english", "english", "اللغة الإنجليزية", "Langue Anglaise", 2, 2.5, "rag_only"),
)
SUBJECTS = ("arabe", "english", "francais", "islamic", "math", "physic", "svt")
SCIENCE = ("math", "physic", "svt")
ARABIC_SUBJECTS = ("arabe", "islamic", "math", "physic", "svt")
ALIASES = {"egnlish": "english"}

# Years with era, completed share of the programme, kinds of sittings, censored, sealed.
YEAR_ROWS = (
    (2008, "early_reform", 77.5, ("regular",), True, False),
    (2009, "early_reform", 85.0, ("regular",), True, False),
    (2010, "early_reform", 77.5, ("regular",), True, False),
    (2011, "early_reform", 80.0, ("regular",), True, False),
    (2012, "early_reform", 82.5, ("regular",), True, False),
    (2013, "early_reform", 87.0, ("regular",), True, False),
    (2014, "early_reform", 82.5, ("regular",), True, False),
    (2015, "stable", 97.5, ("regular",), False, False),
    (2016, "stable", 100.0, ("regular", "reexam"), False, False),
    (2017, "stable", 100.0, ("regular", "exceptional"), False, False),
    (2018, "stable", 100.0, ("regular",), False, False),
    (2019, "stable", 100.0, ("regular",), False, False),
    (2020, "covid", 65.0, ("regular",), True, False),
    (2021, "covid", 72.5, ("regular",), True, False),
    (2022, "covid", 77.5, ("regular",), True, False),
    (2023, "modern", 100.0, ("regular",), False, False),
    (2024, "modern", 100.0, ("regular",), False, False),
    (2025, "modern", 100.0, ("regular",), False, False),
    (2026, "modern", 100.0, ("regular",), False, True),
)

# Names of files, texts and images.
SINGLE_NAME = r"(?i)^bac_([a-z]+)_([0-9٠-٩]{4})_sujet([12])(?:_(solution))?(?:_session([12]))?\.pdf$"
COMBINED_NAME = r"(?i)^bac_([a-z]+)_([0-9٠-٩]{4})_sujet1_and_sujet2(?:_(solution))?(?:_session([12]))?\.pdf$"
PROGRAMME_NAME = r"(?i)^curriculum_([a-z]+)\.(txt|pdf)$"
THRESHOLD_NAME = r"(?i)^threshold_([a-z]+)_([0-9٠-٩]{4})\.(txt|pdf)$"
STEM = r"^bac_([a-z]+)_([0-9]{4})_sujet([0-9])(_solution)?(?:_session([0-9]))?$"
IMAGE_NAME = r"^(.+)_page([0-9]+)_img([0-9]+)\.png$"
PAGE_KEY = r"^(.*)__p([0-9]+)$"
PAGE_MARK = r"^\[PAGE\s+(\d+)\]"

# Headings, ordinals, words for points, vowel signs, inline markup.
ORDINALS = {"الأول": 1, "الاول": 1, "الثاني": 2, "الثالث": 3, "الرابع": 4, "الخامس": 5, "التجريبي": 9}
KEY_ORDINALS = {"الأول": 1, "الاول": 1, "الثاني": 2, "الثالث": 3, "الرابع": 4, "الخامس": 5, "السادس": 6, "السابع": 7}
EXERCISE, PART = "التمر[يب]ن", "الجزء"
POINTS = "نقاط|نقطة|نقطتان|نقط|ن"
MARKS = "[\u0610-\u061a\u064b-\u065f\u0670\u06d6-\u06ed\u0640]"
MARKUP = r"</?u>|</?b>|\*\*|__|\$?\\underline\{\\text\{|\}\}\$?|[\u200e\u200f]"
CELL_MARKUP = r"\*\*|__|</?u>|</?b>|\\underline\{\\text\{|\}\}"
TOPIC_MARK = r"^[\s#*_\-(]*(?:عناصر الإجابة\s*\(?\s*)?الموضوع\s+(الأول|الاول|الثاني)\b"
FIGURE_MARK = r"(?s)\[FIGURE:.*?\]"
PAGE_FOOTER = (
    r"(?i)^(?:صفحة|الصفحة)\s*[\d٠-٩]+\s*من\s*[\d٠-٩]+|^[\d٠-٩]+\s*/\s*[\d٠-٩]+\s*$|^page\s*\d+|اقلب الصفحة|^اختبار في مادة|^تابع (?:الإجابة|للإجابة)"
    r"|^الإجابة النموذجية|^عناصر الإجابة|^\[FIGURE"
)

# The forms in which a numbered question or answer opens, left to right and as the text layer turns them.
LABEL = (
    r"^[\s\(\[]*(?:الجزء\s+\S+\s*[:：]\s*)?(?:I{1,3}V?\s*[\)\.\-–/]{1,2}\s*)?(?:[أابجدهـ]\s*[/\)\-–]\s*)?(?:Act(?:ivity)?\s+)?"
    r"([1-9]\d?(?:\.\d+)*|[١-٩][٠-٩]?(?:\.[٠-٩]+)*)\s*[\)\]\.\-–/:]\s*(?=\S|$)"
)
TURNED_LABELS = (
    r"[\-–]\s*([1-9]\d?|[١-٩][٠-٩]?)\s+(?=[^\d\s$])",
    r"\(\s*([1-9]\d?|[١-٩][٠-٩]?)(?:\s*$|\s+(?=[^\d\s)+\-*/=]))",
    r"\.([1-9]\d?(?:\.\d+)*)\s+(?=[^\d\s])",
    r"ج\s*([1-9]\d?)\s*[\-–:\.)]\s*(?=\S)",
    r"الجواب\s+(?:على\s+السؤال\s+)?(الأول|الاول|الثاني|الثالث|الرابع|الخامس|السادس|السابع)\s*[:\-–]?",
    r"([1-9]\d?)\s+(?![Pp]ts?\b|[Pp]oints?\b)(?=[A-Z][a-z])",
    r"([1-9]\d?)\s+(?=(?:صحيح|خاطئ|خطأ|الاقتراح|الجواب|الإجابة|لدينا|تبيان|تبيين|بيان|إثبات|اثبات|حساب|من أجل"
    r"|إيجاد|ايجاد|رسم|إنشاء|انشاء|التحقق|تعيين|عبارة|معادلة|جدول|إشارة|اشارة|دراسة|استنتاج|قيمة|طبيعة|تحديد|تفسير|تمثيل"
    r"|أ\)|ب\)|ج\)|جـ\)|\(I|I\)|II\)))",
)
#: Parts of a dotted label after the first are 12 at most.
DEEPEST_PART = 12

# Sections of the language subjects, first rule that fits a fragment wins.
SECTION_RULES = {
    "arabe": (
        ("text", r"النص\s*(?:[:：]|$)"),
        ("questions", r"الأسئلة\s*:?\s*$"),
        ("fikri", r"(?:أولا|اولا|أ|ب|ج)?[\s\-–:\.\)]*البناء الفكري"),
        ("lughawi", r"(?:ثانيا|أ|ب|ج)?[\s\-–:\.\)]*البناء اللغوي"),
        ("naqdi", r"(?:ثالثا|ج)?[\s\-–:\.\)]*التقويم النقدي"),
    ),
    "islamic": (("part1", r"الجزء الأول"), ("part2", r"الجزء الثاني")),
    "francais": (
        ("text", r"texte\s*:?\s*$"),
        ("questions", r"questions\s*:?\s*$"),
        ("comprehension", r"(?:I\s*[\.\-–/:]?\s*)?compr[ée]hension(?:\s+de\s+l['’][ée]crit)?"),
        ("production", r"(?:II\s*[\.\-–/:]?\s*)?production(?:\s+de\s+l['’])?\s*[ée]crite?\b|II\s*[\.\-–/:]?\s*production\b"),
    ),
    "english": (
        ("reading", r"part\s+(?:one|1|I)\b(?!I)"),
        ("exploration", r"(?:B[\)/\.\-]?\s*)?text\s+exploration"),
        ("writing", r"part\s+(?:two|2|II)\b"),
    ),
}
SECTION_LEAD = r"^[\s#*_\-–>\(\[]*"
SECTION_POINTS = r"[\s:：\-–]*[\(\[]?\s*(?P<pts>[\d٠-٩]+(?:[.,]\d+)?)\s*[\)\]]?\s*(?:نقاط|نقطة|نقط|points?|pts?)"
SECTION_NAMES = {
    "text": "النص", "questions": "الأسئلة", "fikri": "البناء الفكري", "lughawi": "البناء اللغوي", "naqdi": "التقويم النقدي",
    "part1": "الجزء الأول", "part2": "الجزء الثاني", "comprehension": "Compréhension de l'écrit", "production": "Production écrite",
    "reading": "Part One: Reading", "exploration": "Text Exploration", "writing": "Part Two: Written Expression",
}
LATE_SECTIONS = frozenset(("lughawi", "naqdi", "production", "exploration", "writing", "part2"))
PRIMARY_SECTIONS = frozenset(("fikri", "comprehension", "reading", "part1"))
HEADER_LINE = (
    r"الجمهورية|وزارة|الديوان|امتحان بكالوريا|دورة|الشعب|اختبار في مادة|المدة|المترشح|الموضوع|يحتوي الموضوع"
    r"|^صفحة|^\[PAGE|République|Ministère|Office|Examen|Session|Filière|Épreuve|Durée|candidat|Sujet\s*\d|Page \d|^\s*$"
)

# Words that ask, and words that say nothing of a text's subject.
ASKING = (
    r"(?i)\?|؟|\b(?:ما|ماذا|لماذا|كيف|هل|أي|أين|متى|بم|بماذا|فيم|علام|اذكر|أذكر|حدد|حدّد|حلل|حلّل|فسر|فسّر|بين|بيّن|استنتج|قارن|اكتب|أكتب|أعط|اعط"
    r"|أنجز|انجز|مثل|مثّل|ارسم|أرسم|وضح|وضّح|اشرح|قدم|قدّم|سم|سمّ|تعرف|تعرّف|عين|عيّن|احسب|أحسب|برهن|أثبت|اثبت|تحقق|ادرس|استخرج|لخص|لخّص|اقترح|صنف|صنّف"
    r"|علل|علّل|ناقش|أكمل|اكمل|ضع|انقل|أنقل|عرف|عرّف|قارن|جد|حل|حلّ|رتب|أعد|اعد|ماهي|ما هي|ما هو|قيم|قيّم|اختر|أجب"
    r"|calcule[zr]?|détermine[zr]?|montre[zr]?|expliqu|justifi|relev|donne[zr]?|cite[zr]?|complét|réponde|identifi|répond|proposez|rédige"
    r"|write|answer|give|choose|find|say|classify|reorder|complete|fill|ask|match|divide|rewrite|circle|identify|what|which|who|why|how)\b"
)
STOP_WORDS = (
    "في من على إلى عن أن إن ما لا لم لن هذا هذه ذلك تلك التي الذي الذين ثم أو و كما كل بين حتى إذا كان كانت هو هي هل بم ماذا لماذا كيف أي مع عند قد لكن غير "
    "the of a an to and or in on for is are be by with that this it as at from des les une un le la et en du de que qui dans pour sur est sont au aux ce cette ces"
).split()
TOKEN = r"\$[^$]+\$|[A-Za-z_]\w*|\d+(?:[.,]\d+)?|[\u0621-\u064A]{3,}"
LAYOUT_MACROS = ("\\text", "\\left", "\\right", "\\,", "\\;")

# Signs of bad extraction.
REVERSED_NAME = "ايرولاكب"
REVERSED_WORDS = (
    "تاريغت", "لودج", "ةراشإ", "جاتنتسا", "ةيبيرجتلا", "ةيملعلا", "ةلادلا", "ةيضايرلا", "ةغللا", "ةيملاسلإا", "ةيبرعلا", "ةعيبطلا", "ةايحلا", "ءايزيفلا",
)
GARBLE = r"[ء-غف-ي]{1,2}(?:\s+[ء-غف-ي]{1,2}){7,}"
SHORT_GARBLE = r"[\u0600-\u06ff]{1,2}(?:\s+[\u0600-\u06ff]{1,2}){5,}"
DIAGRAM = "الشكل|وثيقة|الوثيقة|بيان|منحنى|مخطط|محور"
REVERSED_LATIN = r"(?i)\b(tejuS|tejus|noitcudorp|noitcudorP)\b"
LATIN_GIBBERISH = r"[a-zA-Z]{1,2}(?:\s+[a-zA-Z]{1,2}){4,}"
PAGE_NOISE = r"\b\d{2,}\s*[ij]\s*\d{2,}\b"
REPROCESS = "[PAGE REPROCESS NEEDED"
GARBLED_PAGE = "[PAGE REPROCESS NEEDED - vertical sidebar garble detected]"
MODEL_TALK = r"(?i)(Here is the extracted text|I will extract|Note:|Commentary:|This page contains|The following text|Translation:|Note that|Please note|I notice)"
QUESTION_FORMS = (
    r"(?i)(Exercise|Exercice|Exercício)\s*\d",
    r"(?i)Question\s*\d",
    r"الجزء\s+(الأول|الثاني|الثالث)",
    r"(أولاً|ثانياً|ثالثاً)\s*:",
    r"(?i)\b(Partie|PARTIE|Texte|Passage)\s*(I|II|III|\d)",
    r"(?m)^\s*\d+[\.\)]\s*\w",
    r"(?m)^\s*[1-9]\s+[\u0600-\u06ff]",
    r"البناء\s+(الفكري|اللغوي|اللّغوي)",
    r"(التمرين|الجزء|السؤال|الموضوع)\s+(الأول|الثاني|الثالث|الأولى)",
    r"(?i)(PART|PARTIE)\s+(ONE|TWO|THREE|I|II|III)",
)
SCIENCE_MARKS = (
    r"[=\+\-×÷≥≤≠∞∑∫√π²³]|\b(mg|kg|km|mol|pH|cm|mm|Hz|kHz|MHz|eV|kJ|cal|°C|°F|K)\b|[A-Z][a-z]?\d*[\+\-]?\d*\b|\d+[\.,]\d+"
)
SECTION_CONTEXT = "(تمرين|جزء|السؤال|سؤال|الجزء|القسم|الفقرة|النقطة|نقطة|علامة)"
SUBJECT_NAMES = {
    "arabe": ("اللغة العربية", "العربية"),
    "english": ("الإنجليزية", "الانجليزية", "English", "الإنكليزية"),
    "francais": ("الفرنسية", "Français", "francais", "français"),
    "islamic": ("العلوم الإسلامية", "الاسلامية", "الإسلامية"),
    "math": ("الرياضيات",),
    "physic": ("العلوم الفيزيائية", "الفيزيائية", "فيزيائية"),
    "svt": ("علوم الطبيعة", "الطبيعة والحياة", "الطبيعة و الحياة"),
}
PAGE_END = r"(?i)(صفحة\s*\d+\s*(?:من|/)\s*\d+|انتهى الموضوع|Page\s*\d+\s*(?:sur|/|of)\s*\d+|FIN DU SUJET|END OF|Fin du sujet)"
LATEX_WORDS = ("sqrt", "frac", "nbsp", "cdot", "ldots", "left", "right", "text", "hline", "begin", "infty", "lim", "quad", "mathbb", "vec", "overrightarrow")
VOWELS = "aeiouyàâäéèêëïîôùûüÿ"
SCORE_TOKEN = (
    r"^(?:0[.,]25|0[.,]5|0[.,]50|0[.,]75|1|01|1[.,]5|1[.,]50|1[.,]25|1[.,]75|2|02|2[.,]5|2[.,]25|2[.,]75|3|03|3[.,]5|4|04|4[.,]5|5|05|6|06|7|07|8|08|[0-9][.,]00"
    r"|\d+\s*[x×]\s*[0-9][.,]\d+|[0-9][.,]\d+\s*[x×]\s*\d+|\d+[x×]\d+[.,]\d+)$"
)

# Forms of formulas that mean the same, noise in lists of formulas, words that are no atoms of one.
FORMULA_FORMS = (
    ("\\dfrac", "\\frac"), ("\\left", ""), ("\\right", ""), ("\\displaystyle", ""), ("\\,", ""), ("\\;", ""), ("\\!", ""), ("\\text{", "{"), ("\\mathrm{", "{"),
    ("\\mathbb{", "{"), ("\\overrightarrow", "\\vec"), ("\\overline", "\\bar"), ("\\qquad", ""), ("\\quad", ""), ("\\cdot", "*"), ("\\times", "*"), ("×", "*"), ("·", "*"),
    ("−", "-"), ("–", "-"), ("≈", "="), ("\\approx", "="), ("\\simeq", "="), ("≃", "="), (",", "."),
)
FORMULA_NOISE = (
    r"^.{0,2}$", r"^```.*", r"^\${1,2}$|^---$|^\*\*\*$", r"^\\?(?:begin|end)\{[^}]*\}$", r"^[\-\*\u2022\u2013\s]+$", r"^\$?\(?\\?[A-Za-z]\)?\$?$", r"^\$?\(?\\[A-Za-z]+\)?\$?$",
    r"^\$?\(?[A-Za-z]_\{?[A-Za-z0-9]\}?\)?\$?$", r"^\$?\\?(?:mathbb\{[A-Z]\}|[A-Z])\$?$",
)
RAISED, LEVEL = "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻₀₁₂₃₄₅₆₇₈₉", "0123456789+-0123456789"
ATOM = r"[A-Za-z]{2,}|\d+(?:\.\d+)?|[A-Za-z]\d+"
ATOM_MACROS = r"\\(?:text|mathrm|mathbf|mathbb|vec|overrightarrow|overline|bar|hat|dfrac|frac|sqrt|left|right|cdot|times|approx|simeq|ell|quad|,|;|!)\b"
NO_ATOMS = "mol min mL MeV mV ms cm kg km nm mm sin cos tan ln log lim exp dx dt et ou de la le des les and the of".split()

# Lines that open with a number and are no label: scores, running feet, axes drawn in characters, options of a choice, names of substances, dates.
NO_LABEL = (
    r"(?U)^[\d.,\s×x+]+$",
    PAGE_FOOTER,
    r"(?U)^\s*[\d.,]+\s*%",
    r"(?iU)^\s*\(?\d+(?:[.,]\d+)?\)?\s*(?:pts?|points?)\b",
    r"[–\-]\s*\||BAC20\d\d/",
    r"(?s)^(?=(?:[^–]*–){3})(?!(?:\P{L}*\p{L}){20})",
    r"(?s)^(?=\()(?:.*?\(\s*[1-9]\s*\)){2}",
    r"(?s)^(?=\d+-[ء-ي])(?=.*[ء-ي]-\d+-)",
    r"(?U)^\s*[\-–]\s*\d+\s+[a-zà-ÿ]",
)
TOO_DEEP = r"\.0*(?:1[3-9]|[2-9]\d|\d{3,})(?:\.|$)"
NUMBERED = r"(?U)\d|الجواب"
# Rules between cells, a number alone in its cell, what may and may not follow one, rows of matching tables, lines of scores, choices.
CELL_RULE = r"(?U)^[\s:\-]+$"
ALONE = r"(?U)^\**\(?\s*(?:[1-9]|1[0-5])\s*[.)]?\**$"
ALONE_CLOSED = r"[.)]\**$"
AFTER_CLOSED = r"(?U)^(?:\**|<u>|[\-–]\s*)?\s*(?:[A-Za-zء-ي(«]|<table|\d+\s*[.)]\s*[A-Za-z])"
AFTER_BARE = r"(?U)^\**\s*[A-Za-zء-ي(]"
AFTER_NEVER = r"(?iU)^\**\s*\(?(?:0?\d+(?:[.,]\d+)?\s*(?:[x×]\s*\d|pts?\b|points?\b|each\b)|0\d)"
MATCHING_ROW = r"(?U)^\s*\d+[.)]?\s+[A-Za-z][\w'-]*\s*(?:\(\s*§\s*\d\s*\))?\s*(?:[a-d]\s*[.)]|Syllables?\b|$)"
SCORES_ONLY = r"(?U)^[\d.,\s×x+()]+$"
CHOICE = r"(?:^|[\s.])(?:[ab]\)|أ\)|ب\)|أ-|ب-)"
# Numbers that may open an item: before any other one, after a smaller one, and first in a strict sequence; characters of an answer on a heading's line.
FIRST_AT_MOST, LATER_AT_MOST, STRICT_FIRST, LEAST_AFTER_HEADING = 12, 15, 3, 15
