"""Fixed values of the text rules: patterns and word lists that decide results.

All patterns are valid for Java and for RE2 (no look-around, no back references); they are
used case-insensitively and on text whose white space has been collapsed.
"""

# --- fixed values -----------------------------------------------------------------------

HTML_NAMES = (
    "a|abbr|b|blockquote|br|code|dd|del|div|dl|dt|em|font|h[1-6]|hr|i|ins|kbd|li|mark|ol|p|pre|q|s|small|span|strike|"
    "strong|sub|sup|table|tbody|td|tfoot|th|thead|tr|tt|u|ul|var"
)
MARKUP = rf"</(?:{HTML_NAMES})\s*>|<(?:br|hr)(?:[^\p{{L}}\p{{N}}_<>][^<>]*)?>|<(?:{HTML_NAMES})\s+[^<>]*>|\{{\{{|\[\["

TARGET = "[A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ]+(?:-[A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ]+)*"
QUOTED_TARGET = f"[«\"']?({TARGET})[»\"']?\\s*[.!]?\\s*$"
FORM_OF = (
    r"^\s*(?:(?:страд(?:ат(?:ельн(?:ое|ый|ая)?)?)?|действ(?:ительн(?:ое|ый|ая)?)?)\.?\s+)?"
    r"(?:прич(?:астие)?|деепр(?:ичастие)?)\.?"
    r"(?:\s+(?:прош(?:едш(?:его|ее|ий)?)?|наст(?:оящ(?:его|ее|ий)?)?|буд(?:ущ(?:его|ее|ий)?)?)\.?)?"
    r"(?:\s+(?:вр(?:емени)?|времени)\.?)?(?:\s+(?:кратк(?:ая|ое|ие)?|полн(?:ая|ое|ые)?)\.?)?"
    r"\s+от\s+(?:(?:гл(?:агола)?|слова|лексемы)\.?\s+)?" + QUOTED_TARGET,
    r"^\s*(?:форма|словоформа)\s+(?:глагола|существительного|прилагательного|причастия|деепричастия|местоимения|"
    r"числительного|наречия)\s+(?:от\s+(?:слова|лексемы)\s+)?" + QUOTED_TARGET,
    r"^\s*(?:(?:именительный|родительный|дательный|винительный|творительный|предложный)\s+падеж|"
    r"(?:единственное|множественное)\s+число)(?:[^\p{L}\p{N}_].{0,90}?)?[^\p{L}\p{N}_](?:слова|лексемы)\s+" + QUOTED_TARGET,
)
#: A gloss that is only grammar although it names no single target word (whole text).
GRAMMAR = (
    r"^(?:(?:форма|словоформа)\s+(?:глагола|существительного|прилагательного|причастия|деепричастия|местоимения|"
    r"числительного|наречия)\s+(?:от\s+(?:слова|лексемы)\s+)?[«\"']?[A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ-]+[»\"']?[.!]?"
    r"|(?:форма|словоформа)(?:[^\p{L}\p{N}_].{0,119})?[^\p{L}\p{N}_](?:слова|лексемы)\s+[«\"']?[A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ-]+[»\"']?[.!]?"
    r"|(?:(?:именительный|родительный|дательный|винительный|творительный|предложный)\s+падеж|"
    r"(?:единственное|множественное)\s+число)(?:[^\p{L}\p{N}_].{0,99})?[^\p{L}\p{N}_](?:слова|лексемы)\s+"
    r"[«\"']?[A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ-]+[»\"']?[.!]?)$"
)
#: Parts of a text one of which every grammar gloss holds (lower case).
GRAMMAR_HINTS = ("прич", "падеж", "словоформ", "склон", "спряж", "форма ", " вр. ")

#: Stems of subject names in a bracket that only tells the field.
DOMAIN_ROOTS = (
    "земельн прав юрид физик математ хим медиц биолог геол геодез электр электрон механ техник инженер строит металлург "
    "энерг информат програм компьют телеком эконом финанс банк бухгалт авиа морск железнодорож автомоб воен криминал "
    "лингв языкозн философ психол социол статист метрол стандарт оптик акуст гидравл пневмат теплотех криоген лазер "
    "полупровод ядерн квант фарм анатом физиол диагност терап хирург эколог астроном косм материаловед нефт газов горн "
    "сельск агрон"
).split()
CONTEXT_STARTS = ("в", "во", "для", "при")

ONOMASTIC = (
    r"^(?:(?:мужское|женское|личное|русское|греческое|английское|еврейское|арабское|индийское|японское|узбекское|"
    r"болгарское|британское|испанское)\s+имя|"
    r"(?:русская|английская|испанская|караимская|немецкая|французская|итальянская)?\s*фамилия|"
    r"имя|топоним|название\s+(?:реки|горы|озера|города|ветра)|"
    r"(?:река|село|деревня|город|озеро|гора|пос[ёе]лок|округ|область|штат|провинция|тауншип)\s+(?:в|во|на)\s+.+|"
    r"(?:столица|приток|ручей|остров|мыс|залив|полуостров)\s+.+|"
    r"(?:древнее|античное|средневековое)\s+(?:царство|государство|город)|"
    r"(?:римский|греческий|скифский|болгарский|еврейский|арабский)\s+(?:номен|антропоним|имя)|"
    r"[а-яё-]{3,32}(?:ское|ская)\s+(?:имя|фамилия)|кличка\s+.+)[.!]?$",
    r"^(?:фамилия|имя|топоним)\s*\([^()]{1,60}\)[.!]?$",
    r"^(?:река|озеро|гора|город|село|деревня|регион|область|провинция|столица)\s+[А-ЯЁ][А-ЯЁа-яё'’.-]{2,60}$",
)
CONCISE = (
    r"^[A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ0-9«»'’.-]+(?:[ ,—–/-]+[A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ0-9«»'’.-]+){0,5}[.!]?$"
)
ALIAS_BEGIN = r"^(?:то\s+же|см|вариант|устар|гипокор|уменьш|димин|к\s)"
ALIAS_PREFIX = (
    r"^(то\s+же,?\s+что(?:\s+и)?|см\.?|вариант\s+(?:написания|названия|именования|формы|имени)|устар\.?\s+вариант|"
    r"гипокор\.?\s+к|уменьш\.?\s+к|димин\.?\s+к|к)\s+(.+?)\s*[.!]?$"
)
ALIAS_BARE = r"^вариант\s+([^\s,;:()]{2,100})[.!]?$"
ALIAS_POS = r"^(?:(?:прил|сущ|нареч|гл|глаг|местоим|числ|имя|существительному|прилагательному|аббревиатуре)\.?\s+)+"
ALIAS_CLASS = (
    r"(?iu)^(?:город|село|деревня|пос[ёе]лок|река|озеро|гора|остров|полуостров|регион|область|провинция|кантон|штат|страна|"
    r"государство|столица|курорт|вулкан|мужское\s+имя|женское\s+имя|фамилия|отчество|термин|название|набор|система|"
    r"устройство|программа|праздник|персонаж|явление)(?:[^\p{L}\p{N}_]|$)"
)
ALIAS_NAMED = (
    r"^.*?([А-ЯЁ][А-Яа-яЁёІіѢѣѲѳѴѵ'’.-]{1,80}(?:\s+[А-ЯЁ][А-Яа-яЁёІіѢѣѲѳѴѵ'’.-]{1,80})?)(?:\s*,.*)?$"
)
ALIAS_LIST = r"(?iu)^[A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ'’.-]+(?:\s+и\s+[A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ'’.-]+){1,3}$"
VAGUE = (
    r"^(?:свойство|способность|явление|процесс).{0,130}[^\p{L}\p{N}_]"
    r"(?:не\s+сразу|каким-либо\s+образом|каким-либо\s+способом)(?:[^\p{L}\p{N}_]|$)"
)
EXAMPLE = r"[◆◇]|\[НКРЯ\]"
EMPTY_META = r"^(?:сокр(?:ащение)?\.?|аббр\.?|имя\s+собственное\.?)$"
FRAGMENT = (
    r"^(?:гора|город|река|деревня|село|пос[ёе]лок|округ|область|провинция|регион|штат|остров|озеро|ручей|приток)\s+"
    r"(?:в|во|на|из)$"
)
OLD_EQUIVALENCE = (
    r"^.{1,120}?\s*\((?:аналогично\s+(?:русскому\s+слову|современным\s+значениям?)|"
    r"аналогично\s+рус\.?(?:скому)?\s+слову)[^)]*\)\s*$"
)
OLD_SOURCES = r"^wiktionary:(?:cu|orv|ru-old)"
URL = r"(?:https?://|www\.)\S"
ABOUT = r"^(?:о|об|обо) "
RESIDUE = (
    r"(?:^|[^\p{L}\p{N}_])(?:\(\s*\)|\[\s*\])(?:[^\p{L}\p{N}_]|$)|^\s*[·•]|\s[·•]\s*$|"
    r"\s(?:[,;|]\s*)+:\s*(?:$|[A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ])|:\s*$|\s(?:[:;,|]\s*){2,}$"
)
LEADING_BRACKETS = r"^(?:\((?:[^()]|\([^()]*\))*\)|\[(?:[^\[\]]|\[[^\[\]]*\])*\])\s*\S"
WIKI_TAIL = r"(?:\(\s*см\.?|(?:^|[^\p{L}\p{N}_])(?:см\.|сокр\.|г\.|из|компанией|корпорацией|фирмой))\s*$"
YEAR = r"(?:^|[^A-Za-zА-Яа-яЁё0-9/_-])(?:1[5-9]\d{2}|20\d{2})(?:[^A-Za-zА-Яа-яЁё0-9/_+-]|$)"
WIKI_HISTORY = (
    r",\s+(?:(?:котор(?:ый|ая|ое|ые)\s+)?(?:был[аио]?\s+)?)?(?:разработан|создан|выпущен|принят|построен|основан|"
    r"представлен|спроектирован|анонсирован|введ[ёе]н|изобрет[ёе]н|открыт|запущен|установлен|поступил|выпускавш|"
    r"выпускающ|производивш|производим|издававш)|"
    r"\s(?:созданн|разработанн|выпущенн|производим|выпускаем|выпускавш|построенн|принят|запущенн|установленн)"
)

#: Penalties of flags, and their order in a flag list.
PENALTIES = {
    "onomastic_stub": 0, "very_short": 0, "very_long": 0, "grammar_residue": 45, "markup_residue": 35,
    "leading_parenthetical": 8, "vague": 14, "early_self_reference": 10, "example_residue": 35,
    "placeholder_definition": 20, "fragment": 30, "old_equivalence_placeholder": 32, "url_residue": 25,
    "redirect_residue": 20, "about_fragment": 24, "bad_residue": 18, "concise_gloss": 0, "encyclopedic_date": 8,
    "broken_fragment": 25,
}
#: Flags that tell something without being a defect.
INFORMATIONAL = ("onomastic_stub", "concise_gloss")

#: Beginnings that select a definition for normalisation (as stored, both cases listed).
CANDIDATE_STARTS = (
    "Сокр. от", "сокр. от", "Аббр. от", "аббр. от", "То же, ч", "то же, ч", "Это ", "это ", "См. ", "см. ", "Обо ",
    "обо ", "К ", "к ", "О ", "о ", "Об ", "об ", "Вариант ", "вариант ", "Уменьш.", "уменьш.", "Гипокор", "гипокор",
    "Димин.", "димин.", "Свойство", "свойство", "Явление", "явление", "Процесс", "процесс", "Способность",
    "способность", "Страд.", "страд.",
)
CANDIDATE_PARTS = ("◆", "◇", "[", "{{", " * ", "()", "[]", "|| :", "; :", ", :", "| :")
CANDIDATE_ENDS = (":", '"', "»", "“", "”", "’")

LABELS = (
    "авиац автомоб агрон анат антропол археол архит астр биол бот бухг вет воен геогр геод геол геральд горн диал "
    "ж\\.-д зоол информ иск ист истор картогр книжн комп косм лингв лит мат мед металл метеорол микробиол минер мифол "
    "мор муз неодобр обл опт перен полигр полит прост псих радио разг редк рел религ с\\.-х социол спорт спец строит "
    "театр тех устар фарм физ физиол филос фин фотогр хим экол экон электр этногр юр шутл ирон бран вульг поэт высок "
    "возвыш офиц канц публиц проф жарг сленг детск охотн рыб кулин текст типогр телеком прогр инж мех букв ласк "
    "пренебр уничиж эвф груб фольк народн адъектив субстантив предикатив"
).split()
#: Year numbers that prose may mention; not part of a name, a version or a range.
YEAR_TOKEN = r"(?<![A-Za-zА-Яа-яЁё0-9/_-])(?:1[5-9]\d{2}|20\d{2})(?![A-Za-zА-Яа-яЁё0-9/_+-])"
#: What makes a year a model number, right before it.
MODEL_BEFORE = r"(?:модел[ьи]|индекса?|типа?|серии)\s+[a-zа-яё0-9./+-]*$"
WIKI_HISTORY_WORDS = (
    "выпуск|производ|разработ|создан|основан|открыт|запущ|поступил|принят|построен|представлен|действовал|издавал"
)
PLACEHOLDERS = ("?", "-", "--", "нет значения", "значение не указано", "значение неизвестно")
PARTICIPLE_ENDINGS = ("ённый", "енный", "анный", "янный", "нутый", "тый", "нный")
EXTRACT_GRAMMAR = (
    r"^(?:форма|формы|родительный|дательный|винительный|творительный|предложный|именительный|множественное|"
    r"единственное)(?:[^\p{L}\p{N}_]|$)"
)
EXTRACT_MARKERS = ("◆", "◇", "{{", "[[", "[НКРЯ]")
