"""Required results of the normalisation of definitions (given by the system this one must agree with)."""

from lexloom.operators import normalize

CASES = [
    ("Ambient Marketing", "(от англ. ambient — окружение) направление в рекламе, использующее окружающую среду.", "ruwiki-lead", "Направление в рекламе, использующее окружающую среду."),
    ("Абзу", "(в шумерской мифологии) мировой океан подземных пресных вод, окружающий землю", "wiktionary:ru", "Мировой океан подземных пресных вод, окружающий землю в шумерской мифологии"),
    ("Бастет", "(в Древнем Египте) имя богини радости и домашнего очага", "wiktionary:ru", "Имя богини радости и домашнего очага в Древнем Египте"),
    ("агонистический", "(в этологии) относящийся к активности, связанной с борьбой", "wiktionary:ru", "Относящийся к активности, связанной с борьбой"),
    ("МОУ", "(в РФ с 2000-х гг.) сокр. от муниципальное образовательное учреждение", "wiktionary:ru", "Муниципальное образовательное учреждение"),
    ("Рефлекс Гордона", "(патологический стопный разгибательный рефлекс) проявляющийся в медленном разгибании I пальца стопы.", "ruwiki-lead", "Патологический стопный разгибательный рефлекс, проявляющийся в медленном разгибании I пальца стопы."),
    ("Он", "(Гелиополь, Гелиополис, Илиополь (Ἡλίουπόλις, егип. Иуну, библ. Он)) один из важнейших городов в Древнем Египте", "wiktionary:ru", "Один из важнейших городов в Древнем Египте"),
    ("Растущее", "(до 1948 года Ойсунки́) село в Бахчисарайском районе Республики Крым", "wiktionary:ru", "Село в Бахчисарайском районе Республики Крым"),
    ("Fairlight CMI", "(с функциями сэмплера и цифровой звуковой рабочей станции) выпущенный в 1979 году компанией .", "ruwiki-lead", ""),
    ("Захват Бахрейна", "Захват Бахрейна войсками персидского шаха Аббаса I в 1602 году. , 1622 год", "ruwiki-lead", "Захват Бахрейна войсками персидского шаха Аббаса I в 1602 году."),
    ("Захват Бахрейна", "Захват Бахрейна войсками персидского шаха Аббаса I в 1602 году. , 1622 год", "wiktionary:ru", "Захват Бахрейна войсками персидского шаха Аббаса I в 1602 году. , 1622 год"),
    ("Национальная пресса (Бразилия)", "Национальная пресса в период с 2007 по 2010 год. , историческое издание Национальной прессы 1991 года.", "ruwiki-lead", "Национальная пресса в период с 2007 по 2010 год."),
    ("Закон о регистрации", "Закон США, принятый в 1938 году .", "ruwiki-lead", "Закон США, принятый в 1938 году."),
    ("Кирха в Кведнау", "Кирха в Кведнау (, ныне называется Северная Гора), районе Кёнигсберга (сейчас — конец улицы Александра Невского в Калининграде).", "ruwiki-lead", ""),
    ("GiNaC", "GiNaC является C++ библиотекой.", "ruwiki-lead", "GiNaC является C++ библиотекой."),
    (".460 Steyr", "Крупнокалиберный патрон, разработанный австрийской компанией Steyr в 2002 году.", "ruwiki-lead", "Крупнокалиберный патрон."),
    (".NET Framework", "Программная платформа, выпущенная компанией Microsoft в 2002 году.", "ruwiki-lead", "Программная платформа."),
    ("Вокульский", "Вокульский (фамилия)", "wiktionary:ru", "Фамилия"),
    ("Физический факультет", "Физический факультет МГУ * Физический факультет УрГУ * Физический факультет СПбГУ", "ruwiki-lead", ""),
    ("Вране", "(м.р.) город в Сербии", "wiktionary:ru", "Город в Сербии"),
    ("4B5B", "Это тип линейного кодирования для передачи данных. 4B5B отображает группы 4 бит в группы 5 бит.", "ruwiki-lead", "Тип линейного кодирования для передачи данных."),
    ("122-мм гаубица Д-30", "Советская буксируемая 122-мм гаубица, принятая на вооружение ВС СССР 12 мая 1960 года.", "ruwiki-lead", "Советская буксируемая 122-мм гаубица."),
    ("Белый дом", "О расстреле Белого дома [3], где заседали депутаты ◆ Белый дом — это пример [НКРЯ]", "wiktionary:ru", ""),
    ("антипасха", "Неделя по Пасхе, Фомина неделя, Красная горка. Антипат м. черный коралл. Антипатия ж. природное отвращение.", "dal", "Неделя по Пасхе, Фомина неделя, Красная горка."),
    ("1000 км Алгарве 2010", "Третий раунд сезона 2010 LMS.", "ruwiki-lead", ""),
    ("LMSS", "Космическая платформа LMSS (сокр. от ) являющаяся подразделением компании.", "ruwiki-lead", "Космическая платформа LMSS, являющаяся подразделением компании."),
]
OWN = [
    ("дом", "Дом — жилое здание", "x", "Жилое здание"), ("x", "об отсутствии воды", "wiktionary:ru", "Отсутствие воды"), ("x", "о том, кто шьёт", "wiktionary:ru", "Тот, кто шьёт"),
    ("x", "(кого-либо) подвергать ампутации", "wiktionary:ru", "Подвергать кого-либо ампутации"), ("x", "(радио-)передатчик", "wiktionary:ru", "Радиопередатчик"),
    ("x", "Рассеянность \"", "x", "Рассеянность"), ("x", "Вода ( ) и лёд", "x", "Вода и лёд"), ("x", None, None, ""), ("x", "", "x", ""), (None, "текст о воде", None, "Текст о воде"),
    ("x", "сокр. от большой дом", "x", "Большой дом"), ("x", "Гора в", "x", ""), ("x", "Текст https://a.b/c", "x", "Текст"),
    ("x", "т" * 30 + "; " + "а" * 300 + "; " + "б" * 200, "dal", "Т" + "т" * 29 + "; " + "а" * 300 + "."),
]
CHANGES = {0: "leading_metadata_removed", 2: "leading_context_rewritten", 9: "wikipedia_orphan_date_tail_removed", 12: "wikipedia_date_punctuation_fixed",
           13: "wikipedia_self_reference_removed", 15: "wikipedia_history_tail_removed", 17: "trailing_descriptor_rewritten", 18: "wikipedia_list_residue_removed",
           20: "wikipedia_extra_sentences_removed", 25: "wikipedia_broken_tail_removed"}


def test_normalize(spark):
    rows = CASES + OWN
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "seq long, lemma string, definition string, source string")
    got = {r.seq: r for r in normalize.normalize(df).collect()}
    wrong = [(rows[i][1], rows[i][3], got[i].text, got[i].changes) for i in range(len(rows)) if got[i].text != rows[i][3]]
    assert not wrong
    assert all(c in got[i].changes for i, c in CHANGES.items()) and not got[10].changes
    assert normalize.normalize(df.limit(0)).count() == 0
