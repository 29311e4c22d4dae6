"""Fixed values of the normalisation of definitions: patterns (Java syntax, Unicode classes) and word lists."""

# --- fixed values -----------------------------------------------------------------------

EXAMPLE_TAIL = r"(?s)\s*[◆◇]\s*.*$"
CORPUS_TAIL = r"(?s)\s*\[(?:НКРЯ|Google Books|источник[^\]]*)\].*$"
SENSE_REFERENCE = r"\s*\[(?:[1-9]|[1-9]\d)\](?=\s|[,.;:—–-]|$)"
CITATION = r"\s*\[(?:\d{1,3}|уточнить|источник[^\]]*)\]"
URL = r"(?:https?://|www\.)\S+"
TRAILING_DESCRIPTOR = r"(?s)^([^()]{1,120}?)\s*\(([^()]{2,100})\)\s*[.!]?$"
DESCRIPTOR_NOUN = (
    r"\b(?:фамили|имя|раздел|глава|город|село|деревн|река|озеро|гора|остров|район|область|провинц|штат|регион|термин|"
    r"название|прозвище|кличка|титул|звание)\w*\b"
)
NEXT_HEADWORD = (
    r"(?<=[.!?])\s+(?=[А-ЯЁA-Z][А-ЯЁа-яёA-Za-z'’.-]{2,50}(?:\s*,\s*[А-ЯЁа-яёA-Za-z'’.-]{2,50}){0,4}\s+(?:м|ж|ср)\.)"
)
ABBREVIATION = r"(?s)^(?:сокр(?:ащение)?\.?|аббр\.?)\s*(?:от\s+)?(.+)$"
BROKEN_STUB = r"^(?:\(\?\)|\?{1,3}|см\.?|\[?хорошо|\(\)\s*[^а-яёa-z0-9]{0,4}|то\.?|сленг\s*\?)$"
BROKEN_LITERALS = ("Над ()", "() овощ")
ABOUT_IN_BRACKETS = r"^\(\s*(?:о|об|обо|про|при|для)\s+[^()]{1,100}\s*\)$"
ABOUT_PREAMBLE = r"^о\s+(?:расстрел|истори|происхожд|употреблен|написан|вариант|значени|случа|назван)\w*\b"
BAD_REMAINDER = (
    r"^(?:выпущенн|созданн|разработанн|основанн|построенн|представленн|известн|провед[ёе]нн|состоявш|запланирован|"
    r"приуроченн|проявляющ)\w*\b"
)
SHIP = r"^(?:HMS|USS|SMS|HMAS|RMS)\b"
META_CONTENT = (
    r"(?:^(?:м\.?\s*р\.?|ж\.?\s*р\.?|ср\.?\s*р\.?|индекс\b)|"
    r"^(?:субстантив|адъектив|предикатив|жарг|сокращ|аббревиат)\w*\.?\b|"
    r"^(?:от\s+)?(?:древне|поздне|средне)?(?:англ|лат|греч|древнегреч|нем|фр|франц|исп|итал|кит|китай|яп|польск|чешск|"
    r"укр|белор|араб|перс|тур|турецк|татарск|казах|ингуш|чечен|мадьярск|венгерск|венгр|чудск|санскр|иврит|порт|нидерл|"
    r"швед|норв|дат)\.?\b|"
    r"перевод\w*\s+с\s+(?:англ|лат|греч|нем|фр|исп|итал)\.?\b|"
    r'пиньин|транслит|букв\.?\s*[«"]|в\s+(?:древне)?(?:греч|египет|шумер|скандинав|иран|славян|удмурт).*мифолог|'
    r"в\s+[а-яё-]{3,32}\s+мифолог|в\s+мифолог|в\s+библи|в\s+индуизм|в\s+зороастр|в\s+кришна|в\s+эпос|в\s+древности\b|"
    r"^у\s+[а-яё-]{3,32}\b|^(?:рег|регион|диал|обл|разг|прост|устар|редк)\.?\??$|"
    r"^(?:кому|кого|чего|что|чем|кем|где|куда|откуда|о\s+ком|о\s+ч[её]м)$|"
    r"(?:\b(?:лат|англ|греч|нем|фр|исп|итал)\.)[^)]*(?:перевод|от\b))"
)
QUOTED_META = r'^[«"“„].{1,100}[»"”](?:\s*[сc])?$'
#: Beginnings ``О том, кто ..`` and what they become.
ABOUT_CLAUSES = (
    (r"^о\s+том,?\s+кто\s+", "Тот, кто "),
    (r"^о\s+том,?\s+что\s+", "То, что "),
    (r"^о\s+том,?\s+у\s+кого\s+", "Тот, у кого "),
    (r"^о\s+том,?\s+у\s+чего\s+", "То, у чего "),
    (r"^о\s+ч[её]м-либо,?\s+что\s+", "Что-либо, что "),
    (r"^о\s+ком-либо,?\s+кто\s+", "Кто-либо, кто "),
)
ABOUT_HEADS = {
    "человеке": "Человек", "женщине": "Женщина", "мужчине": "Мужчина", "девушке": "Девушка", "ребёнке": "Ребёнок",
    "ребенке": "Ребёнок", "подростке": "Подросток", "лице": "Лицо", "месте": "Место", "состоянии": "Состояние",
    "ощущении": "Ощущение", "наличии": "Наличие", "отсутствии": "Отсутствие", "желании": "Желание",
    "необходимости": "Необходимость", "возможности": "Возможность", "чувстве": "Чувство", "звуке": "Звук",
    "голосе": "Голос", "крике": "Крик", "пении": "Пение", "начале": "Начало", "сборе": "Сбор", "корне": "Корень",
    "цвете": "Цвет", "времени": "Время", "ситуации": "Ситуация", "ошибке": "Ошибка", "случае": "Случай",
    "способе": "Способ", "явлении": "Явление", "процессе": "Процесс", "действии": "Действие", "движении": "Движение",
    "свойстве": "Свойство", "форме": "Форма", "смысле": "Смысл", "значении": "Значение",
}
ABOUT_NOMINAL = r"(?s)^(?:о|об|обо)\s+([А-Яа-яЁё-]+)((?:\s|[,;:—–-]).*)?$"
ABOUT_TARGET = r"^(?:о|об|обо)\s+(.+?)[.!]?$"
ABOUT_NOT_TARGET = r"^(?:том,|том |чём-либо|чем-либо|ком-либо)"
ABOUT_CLASS = (
    r"^(?:городе|селе|деревне|реке|озере|горе|острове|полуострове|рыбе|птице|растении|животном|насекомом)\s+(.+)$"
)
DEPENDENT_HEADS = {
    "о растворителе": "Растворитель", "об объекте": "Объект", "о веществе": "Вещество", "о системе": "Система",
    "об устройстве": "Устройство", "о молекуле": "Молекула", "о молекулах": "Молекулы",
}
DEPENDENT_REST = r"^(?:молекулы|части|элементы) котор(?:ого|ой|ых)"

# brackets at the beginning
SEMANTIC_CLASS = (
    r"^(?:мужское|женское|личное|русское|испанское|караимское|фамилия|имя|река|село|деревня|город|озеро|гора|сопка|термин|"
    r"доктрина|инструмент|танк|реактор|оборудование|компьютер|платформа|устройство)\b"
)
COMPACT_SPELLING = r"^[A-Za-zА-Яа-яЁёІіЇїЄєҐґ'’.-]+(?:\s+[A-Za-zА-Яа-яЁёІіЇїЄєҐґ'’.-]+)?$"
PLACE_OR_NAME = r"\b(?:город|рек|сел|деревн|озер|гор|район|област|провинц|государств|царств|фамили|имя)\w*\b"
YEAR_RANGE = r"(?s)^\(((?:до|с)\s+(?:1[5-9]\d{2}|20\d{2})(?:-х)?\s*(?:г\.?|гг\.?|года|годов)?)\)\s*(.+)$"
YEAR_BEGIN = r"^(?:до|с)\s+(?:1[5-9]\d{2}|20\d{2})\b"
PLACE_BEGIN = r"^(?:село|деревня|город|пос[ёе]лок|река|озеро|гора|район|область)\b"
REGISTER_BEGIN = r"^(?:сокращ|аббревиат|жарг|субстантив|адъектив|предикатив)\w*\.?\b"
ACRONYM = r"\b[A-ZА-ЯЁ0-9-]{2,12}\s*[-—–:=]\s*"
CALLED = r"(?s)^называется\s+(.+)$"
MORE_DOMAINS = (
    r"(?:этолог|фармаколог|зоолог|ботаник|стихослож|метрик|гимнастик|лфк|номенклатур|лингвистик|фонетик|морфолог|синтакс)\w*"
)
USAGE_BEGIN = (
    r"^(?:обычно|только|преим(?:ущественно)?|в\s+речи|с\s+оттенком|редко|уголовн(?:ый|ая)\s+сленг|советск\.?|разг\.?|"
    r"прост\.?|устар\.?|бранн\.?|перен\.?|книжн\.?|поэт\.?|ирон\.?|неодобр\.?)\b"
)
SLOT = r"^(?:кого|кому|кем|чего|чему|чем|кого-либо|кому-либо|кем-либо|чего-либо|чему-либо|чем-либо)$"
VERB_WORD = r"^[А-Яа-яЁё-]+(?:ть|ти|чь|ет|ит|ать|ять)(?=\s|$)"
KEPT_ADJECTIVE = r"^(?:врожд[ёе]нн(?:ый|ая|ое)|съ[ёе]мн(?:ый|ая|ое)|полностью)$"
PREFIX_NOTE = r"^[A-Za-zА-Яа-яЁё-]{2,40}-$"
LANGUAGE_BEGIN = (
    r"^(?:ивр(?:ит)?|греч(?:еск)?|лат(?:инск)?|англ(?:ийск)?|нем(?:ецк)?|фр(?:анц)?|исп(?:анск)?|кит(?:айск)?|"
    r"яп(?:онск)?|санскритск|инг\.|чеч\.)\b"
)
DROPPED_METAS = ("санскритский термин", "геометрическое представление")
JOINED_METAS = ("историческая", "исторический", "историческое", "высокий", "низкий")
CULTURE = "мифолог|религи|фольклор|эпос"

# old dictionary articles
OLD_REGION = r"^(?:арх|астрах|влад|вологодск|вор|вят|калуж|камч|костр|ниж|новг|олон|пенз|перм|ряз|сиб|смол|твер|тул|южн)\.\s*[,;:]?\s*"
OLD_USAGE = r"^стар\.\s*[,]?\s*(?:а\s+местами\s*\([^)]{1,60}\)\s+и\s+ныне\s*:?\s*)?"
OLD_SPECULATION = r"(?s)^\s*\(([^()]{1,180})\)\s*[,;:—–-]*\s*(.+)$"
SENTENCE_BORDER = r"(?<=[.!?])\s+(?=[А-ЯЁA-Z0-9«(])"
OLD_EXAMPLE = (
    r"^(?:я|ты|он|она|мы|вы|они|кто|что|как|где|коли|ежели|если|не|дай|дайте|погляди|посмотри|хороша|хорошо|жив[ёе]м|"
    r"стоит|эка|уж|ну)\b"
)
OLD_SECONDARY = (
    r"^(?:арх|астрах|влад|вологодск|вор|вят|калуж|камч|костр|ниж|новг|олон|пенз|перм|пск|ряз|сиб|смол|твер|тул|южн|зап|"
    r"вост|моск|морск|торг|церк|стар)\."
)
OLD_DERIVATIVE = (
    r"\b(?:умалит|ласкат|бранн|прилаг|нареч|сущ|глаг|действ\.|страдат\.|относящ|собират|мн\.|ед\.|ср\.|м\.|ж\.)\b"
)
OLD_POS_SUFFIX = r"\s+(?:м|ж|ср|об|мн|ед)\.?\s*$"

# encyclopedia leads
LIST_RESIDUE = r"(?s)(?:\s+\*\s+.*){2,}"
ENTITY_NOISE = (
    r"^(?:.*?\b)?(?:раунд\s+сезона|этап\s+(?:сезона|серии|чемпионата)|"
    r"(?:автомобильная|автомобильный|ежегодная|ежегодный)?\s*гонка\b|чемпионат\s+мира\b|киберспортивная\s+команда\b|"
    r"(?:музыкальный\s+)?сборник\b|альбом\b|музыкальная\s+группа\b|джазовое\s+трио\b|торговый\s+центр\b|"
    r"пятизв[ёе]здочный\s+отель\b|праздничн(?:ое|ые)\s+мероприят|фестиваль\b)"
)
EVENT_WORD = r"\b(?:гонка|раунд|этап|чемпионат)\b"
EVENT_TITLE = (
    r"(?:\b(?:19|20)\d{2}\b|^\d+\s+(?:час(?:а|ов)?|км)\b|(?:чемпионат|world championship|серия\s+ле-ман|ле-мана)\b)"
)
_DATE = r"(?:1[5-9]\d{2}|20\d{2})\s*(?:г(?:г)?\.?|год(?:а|у|ом|ы)?)"
ORPHAN_DATE = rf"^(.+?[.!?])\s*[,;:—–-]\s*(?:{_DATE})\s*[.,;:)]*\s*$"
ORPHAN_HISTORY = (
    r"^(.+?[.!?])\s*[,;:—–-]\s*(?:(?:историческ\w*|впоследстви\w*|позднее|ныне|сейчас|в\s+настоящее\s+время)\b"
    rf"[^.!?]{{0,220}}{_DATE}\s*[.!?])$"
)
DATE_SPACE = rf"({_DATE})\s+([.,;:])"
BROKEN_SELF_REFERENCE = r"^\s*\(\s*[,;:]"
EMPTY_ABBREVIATION = r"\s*\(\s*(?:сокр(?:ащение)?\.?|аббр(?:евиатура)?\.?)\s+от\s*\)\s*"
MEDIA_TAIL = r"\s*[.)]*\s*(?:на\s+почтовой\s+марке|на\s+фотографии|на\s+иллюстрации)\s*$"
SEE_TAIL = r"\s*\(\s*см\.?\s*$"
DANGLING_TAIL = r"(?:\(\s*см\.?|\bсм\.|\bсокр\.|\bг\.|\bиз|\bкомпанией|\bкорпорацией|\bфирмой)\s*$"
FIRST_SENTENCE = r"(?s)^(.*?[.!?])(?=\s+[А-ЯЁA-Z0-9]|$)"
HISTORY_CLAUSE = (
    r",\s+(?:(?:котор(?:ый|ая|ое|ые)\s+)?(?:был[аио]?\s+)?)?(?:разработан|создан|выпущен|принят|построен|основан|"
    r"представлен|спроектирован|анонсирован|введ[ёе]н|изобрет[ёе]н|открыт|запущен|установлен|поступил|выпускавш|"
    r"выпускающ|производивш|производим|издававш)\w*\b"
)
HISTORY_INLINE = (
    r"\s+(?:созданн|разработанн|выпущенн|производим|выпускаем|выпускавш|построенн|принят|запущенн|установленн)\w*\b"
)
GENERIC_CORES = (
    "автомобиль", "компьютер", "программа", "проект", "сервис", "сайт", "веб-сайт", "компания", "организация", "спутник",
    "устройство", "система", "приложение",
)
NAMED_CORE = (
    r"^(суперкомпьютер|микрокомпьютер|автомобиль|кроссовер|седан|пикап|электромобиль(?:-[а-яё-]+)?|минивэн|микровэн|фургон|"
    r"родстер|купе|тарга|концепт-кар|электробус|автобус|двигатель)\b"
)
HISTORICAL_BARE = r"^(?:к\s+)?([A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ][A-Za-zА-Яа-яЁёІіѢѣѲѳѴѵ'’.-]{1,80})[.!]?$"

#: Warnings that call for a better meaning from the encyclopedia.
WEAK_FLAGS = (
    "very_short", "vague", "early_self_reference", "leading_parenthetical", "old_equivalence_placeholder", "url_residue",
    "broken_fragment", "about_fragment", "redirect_residue", "bad_residue",
)
