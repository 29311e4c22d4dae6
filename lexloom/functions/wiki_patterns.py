"""Fixed values of the encyclopedia source: categories, titles and leads that decide what is taken (any case)."""

# --- fixed values -----------------------------------------------------------------------

DOMAIN = "|".join(
    """физ математ хими биолог ботан зоолог медиц анатом физиолог фарма ветерин заболев болезн синдром патолог терап хирург
    диагност симптом эпидемиол онколог кардиол невролог педиатр стоматолог иммун генет биохим микробиол инженер техник
    технолог механ машиностро электр электрон радио телеком информат компьют программ кибер строител архитект материал
    металлург геолог геодез картограф метеоролог эколог астроном косм авиа морск судостро железнодорож автомоб транспорт
    энергет нефт газ горн агро сельск метролог стандарт оптик акуст робот автоматик прибор юрид право закон судеб уголов
    гражданск административ конституцион патент налог тамож эконом финанс банк бухгалтер страх логист маркет менедж
    статист лингвист языкозн филолог литературовед философ психолог социолог политолог военн оруж криминал полиграф
    издатель музык искусствовед спорт кулинар пищев професс ремес производств свар токар слесар электромонтаж
    деревообработ станк триболог гидравл пневмат теплотех холодил криоген лазер полупровод микроэлектрон нанотех квант
    ядерн атомн спектроскоп кристаллограф минералог петрограф""".split()
)
NOISE = "|".join(
    """персонали;родивш;умерш;люди;лауреат;члены;академики;выпускники;преподаватели;профессора;учёные по алфавиту;физики;
    химики;математики;врачи;инженеры;юристы;программисты;архитекторы;экономисты;биологи;геологи;лингвисты;политики;
    спортсмены;акт[ёе]ры;режисс[ёе]ры;музыканты;писатели;поэты;журналисты;компании;организации;предприятия;университеты;
    институты;города;сёла;деревни;реки;оз[ёе]ра;районы;станции метро;фильмы;телесериалы;альбом;песн;книг;монограф;сборник;
    игры по алфавиту;музыкальн.*групп;рок-групп;музыкальн.*коллектив;видеоигр;компьютерн.*игр;киберспортивн.*команд;газеты;
    журналы;телеканалы;радиостанции;издательства;бренды;торговые марки;воинские части;воинские формирования;дивизии;
    бригады;полки;батальоны;военные операции;астероиды;малые планеты;транснептуновые объекты;населённые пункты;посёлки;
    музеи;галереи;памятники;торговые центры;отели;просветительские проекты;юбилеи;спортивн.*соревнован;спортивн.*сезон;
    автогон;автоспорт;чемпионат;турнир""".replace("\n    ", "").split(";")
)
BAD_TITLE = (
    r"^(?:список|перечень|хронология|дискография|библиография|\d{1,4}\s+год(?:[^\p{L}\p{N}_]|$)|\(\d+\)\s*|"
    r"\d{1,4}-(?:й|я|е)(?:[^\p{L}\p{N}_]|$))"
)
BAD_QUALIFIER = (
    r"\((?:группа|фильм|альбом|песня|игра|компания|газета|журнал|дивизия|полк|бригада|батальон|корпус|операция|сезон|деревня|"
    r"село|пос[ёе]лок|город|музей|галерея)\)\s*$"
)
ENTITY_LEAD = (
    r"^(?:[А-ЯЁA-Z][^.!?]{0,35}\s+)?(?:рок-группа|музыкальная группа|музыкальный коллектив|поп-группа|фильм|телесериал|роман|"
    r"книга|альбом|песня|компьютерная игра|видеоигра|газета|журнал|воинская часть|тактическое соединение|"
    r"соединение кавалерии|пехотная дивизия|авиационный полк|астероид|транснептуновый объект|населённый пункт|деревня|"
    r"пос[ёе]лок|художественная галерея)(?:[^\p{L}\p{N}_]|$)"
)
