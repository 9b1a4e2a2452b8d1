"""Default rule list of the page classifier.

A rule is (part, ord, status, pattern, word). ``part`` is url, title,
description or content; a ``word`` rule is wrapped in word boundaries, any
other pattern is searched as it stands. Parts are tried in PARTS order, rules
of a part by ``ord``.
"""

from __future__ import annotations

from typing import NamedTuple

PARTS = ("url", "title", "description", "content")


class Rule(NamedTuple):
    part: str
    ord: int
    status: int
    pattern: str
    word: bool = True


# Patterns searched as they stand, before the words of the part.
URL_PATTERNS = [
    (4200, ["porn"]),
    (4300, ["1xbet"]),
]
TITLE_PATTERNS = [
    (1300, [r"1[\s]*[xх][\s]*[Bb][eе]t"]),
    (1700, [
        r"\b[Дд]омен\b[a-zA-Zа-яА-Я0-9\.\-\s]*\bпрода[её]тся\b",
        r"\b[Дд]омен\b[a-zA-Zа-яА-Я0-9\.\-:\s]*\bкупить\b",
    ]),
]
CONTENT_PATTERNS = [
    # Starts with a capital while the text is lower-cased, so it never hits.
    (3100, [r"Сайт[a-zA-Zа-яА-Я0-9\.\-:\s]*только что создан"]),
]

# Words and phrases by part and status.
TITLE_WORDS = [
    (1000, [
        "404", "403", "welcome to nginx", "blank page", "coming soon", "loading", "not found",
        "error", "To Bet, игровая платформа", "в разработке", "under construction",
        "没有找到站点", "доступ заблокирован",
    ]),
    (1100, [
        "timeweb", "срок регистрации", "доменное имя продается", "домен продается",
        "домен продаётся", "домен не прилинкован", "for sale", "домен уже",
        "площадке интернет", "витрина домена", "to centos", "доменное имя", "купить домен",
        "вы владелец сайта", "отключен", "это тестовый", "продаётся домен",
        "домен не добавлен", "domain name", "не опубликован", "на технической площадке",
        "припаркован", "данный домен", "домен зарегистрирован", "не работает",
        "сайт успешно", "который можно купить", "хостинг vps", "файл отсутствует",
        "домен не настроен", "сайт не запущен", "are not published",
        "действие аккаунта приостановлено", "ukit — сайт не оплачен",
        "welcome to adminvps!", "упс! домен не видит хостинг",
        "запрошенный сайт отсутствует на нашем хостинге", "pages are not published",
        "fastpanel", "FASTPANEL2", "lptrend | конструктор лендингов", "SpaceWeb",
        "Success!", "Alle Bikes", "Настройте домен правильно", "сайт заблокирован",
        "сайт создан", "купить красивый домен",
    ]),
    (1200, [
        "порно", "porn", "sex", "секс", "проститутки", "шлюхи", "brazzers", "хентай",
        "бдсм", "геи", "увеличить член", "порнуха", "порнуху",
    ]),
    (1300, [
        "1x", "1х", "казино", "casino", "займ", "букмекер", "Займы до 500 000",
    ]),
    (1400, [
        "здоровая росссия", "РќРµ РѕРїСѓР±Р»РёРєРѕРІР°РЅ", "как вы здесь оказались",
        "временно недоступен", "недоступен", "доступ ограничен", "закрыто",
        "доступ к сайту", "default page", "ещё один сайт", "на реконстркции",
        "заглушка для сайта", "index of", "без названия", "report",
    ]),
    (1500, ["страница входа", "captcha", "just a moment"]),
    (1600, ["access denied", "website"]),
    (1700, ["Domenomania"]),
]
DESCRIPTION_WORDS = [
    (2000, ["default index page"]),
    (2200, [
        "порно", "porn", "sex", "секс", "проститутки", "шлюхи", "brazzers", "хентай",
        "бдсм", "геи", "увеличить член", "порнуха", "порнуху",
    ]),
    (2300, ["ставки", "ставка"]),
    (2500, ["закрытый форум"]),
    (2600, ["ещё один сайт на wordpress"]),
    (2700, ["магазин доменных имен"]),
]
CONTENT_WORDS = [
    (3000, [
        "we'll be back soon!", "403 forbidden", "эта страница генерируется автоматически",
        "если этот сайт принадлежит вам", "сайт находится в стадии разработки",
    ]),
    (3100, ["reg.ru", "ISPsystem © 1997-"]),
    (3200, [
        "пусть домен работает", "цифирные домены от", "этот домен продается",
        "account has been suspended",
    ]),
]


def default_rules() -> list[Rule]:
    """The default list; pass your own ``Rule`` list to use other words."""
    groups = {
        "url": (URL_PATTERNS, []),
        "title": (TITLE_PATTERNS, TITLE_WORDS),
        "description": ([], DESCRIPTION_WORDS),
        "content": (CONTENT_PATTERNS, CONTENT_WORDS),
    }
    rules: list[Rule] = []
    for part, (patterns, words) in groups.items():
        for is_word, entries in ((False, patterns), (True, words)):
            for status, texts in entries:
                for text in texts:
                    rules.append(Rule(part, len(rules), status, text, is_word))
    return rules
