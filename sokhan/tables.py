"""Characters and words that the rules work with.

The values below are fixed: results depend on each of them.
"""

from __future__ import annotations

ZWNJ = "‌"
#: Blanks as Unicode defines them, with the four information separators.
BLANK = "\\p{IsWhite_Space}\\x1C-\\x1F"
BLANKS = "".join(c for c in map(chr, range(0x10000)) if c.isspace())

# Characters.
REMOVED = "‍​‎‏‪‫‬‭‮﻿­ـ"
SPACES = "              　\t\v\f"
FATHATAN, FATHA, DAMMA, KASRA, SHADDA, SUKUN = "ًَُِّْ"
MARKS = "ًَُِّْ"
DROPPED_MARKS = "ٌٍٰٕٓٔ"
LETTERS_FA = "ابپتثجچحخدذرزژسشصضطظعغفقکگلمنوهیآأإئؤءۀ"
FALLBACK_LETTERS = "پچژگ"
FOLDED = {
    "ك": "ک", "ڪ": "ک", "ى": "ی", "ي": "ی", "ے": "ی", "ۓ": "ی", "ة": "ه", "ۀ": "ه", "ٱ": "ا", "ٵ": "ا", "ٶ": "و", "ٷ": "و", "ڤ": "ف", "ڥ": "ف", "ڧ": "ق", "ڨ": "ق",
    "٠": "0", "١": "1", "٢": "2", "٣": "3", "٤": "4", "٥": "5", "٦": "6", "٧": "7", "٨": "8", "٩": "9",
    "۰": "0", "۱": "1", "۲": "2", "۳": "3", "۴": "4", "۵": "5", "۶": "6", "۷": "7", "۸": "8", "۹": "9",
}
PHRASES = {"ﷺ": "صلی الله علیه و آله و سلم", "ﷻ": "جل جلاله", "ﷲ": "الله", "﷽": "بسم الله الرحمن الرحیم"}
PUNCTUATION = {
    ",": "،", "，": "،", "、": "،", ";": "؛", "；": "؛", "?": "؟", "？": "؟", "۔": ".", "。": ".", "．": ".", "！": "!", "：": ":",
    "–": "-", "—": "-", "―": "-", "−": "-", "‘": "'", "’": "'", "‚": "'", "‛": "'",
    "“": "«", "”": "»", "„": "«", "‟": "»", "‹": "«", "›": "»", "`": "'", "´": "'", "٭": "*",
}
BULLETS = "•●▪"
KEPT_PUNCTUATION = ".!:-'،؛؟«»…"
SUFFIXES = ("ها", "های", "هایی", "تر", "ترین", "ام", "ات", "اش")

# Number words.
ZERO, NEGATIVE, POSITIVE, POINT = "صفر", "منفی", "مثبت", "ممیز"
DIGITS = ["صفر", "یک", "دو", "سه", "چهار", "پنج", "شش", "هفت", "هشت", "نه"]
TEENS = ["ده", "یازده", "دوازده", "سیزده", "چهارده", "پانزده", "شانزده", "هفده", "هجده", "نوزده"]
TENS = ["", "", "بیست", "سی", "چهل", "پنجاه", "شصت", "هفتاد", "هشتاد", "نود"]
HUNDREDS = ["", "صد", "دویست", "سیصد", "چهارصد", "پانصد", "ششصد", "هفتصد", "هشتصد", "نهصد"]
SCALES = ["", "هزار", "میلیون", "میلیارد", "بیلیون", "بیلیارد", "تریلیون", "تریلیارد"]
PLACES = ["", "دهم", "صدم", "هزارم", "ده‌هزارم", "صد‌هزارم", "میلیونم"]

# Dates, money, units, abbreviations.
JALALI = ["فروردین", "اردیبهشت", "خرداد", "تیر", "مرداد", "شهریور", "مهر", "آبان", "آذر", "دی", "بهمن", "اسفند"]
GREGORIAN = ["ژانویه", "فوریه", "مارس", "آوریل", "مه", "ژوئن", "ژوئیه", "اوت", "سپتامبر", "اکتبر", "نوامبر", "دسامبر"]
CURRENCY = {"$": "دلار", "€": "یورو", "£": "پوند", "﷼": "ریال", "¥": "ین"}
UNITS = {
    "km": "کیلومتر", "m": "متر", "cm": "سانتی‌متر", "mm": "میلی‌متر", "kg": "کیلوگرم", "g": "گرم", "mg": "میلی‌گرم", "l": "لیتر", "ml": "میلی‌لیتر",
    "km/h": "کیلومتر بر ساعت", "m/s": "متر بر ثانیه", "GB": "گیگابایت", "MB": "مگابایت", "KB": "کیلوبایت", "TB": "ترابایت", "GHz": "گیگاهرتز", "MHz": "مگاهرتز", "Hz": "هرتز",
    "°C": "درجه سانتی‌گراد", "°F": "درجه فارنهایت", "°": "درجه",
}
ABBREVIATIONS = {
    "ه.ق": "هجری قمری", "ه‌ق": "هجری قمری", "هـ.ق": "هجری قمری", "ه.ش": "هجری شمسی", "ه‌ش": "هجری شمسی", "هـ.ش": "هجری شمسی", "ق.م": "قبل از میلاد", "ب.م": "بعد از میلاد",
    "ص.": "صفحه", "ج.": "جلد", "ش.": "شماره", "و غیره": "و غیره", "الخ": "و غیره", "ن.ک": "نگاه کنید", "ر.ک": "رجوع کنید", "م.": "میلادی",
}

# Shares of marked words in training text, and the stand-in tokenizer.
DENSITY_MIX = ((0.60, 0.10, 0.25), (0.25, 0.40, 0.60), (0.15, 1.00, 1.00))
MERGES = ("ان", "می", "ها", "ست", "ند", "را", "در", "که", "این", "آن")
SINGLE_TOKENS = "ابتثجحخدذرزسشصضطظعغفقکلمنوهیآأإئؤء ‌.,!?:«»،؛؟…"
PROBES = ("کِرْم", "پژگچ", "می‌روم", "نیم‌فاصله", "واقعاً", "دانشگاهِ تهران", "۱۴۰۳", "مُرْد", "مَرْد", "سِپاهانِ اصفهان", "کُتُبْ", "بچّه", "مسئله", "آنها", "«نقل قول»", "سه ممیز یک چهار")
#: Latin words and their Persian readings.
LATIN_WORDS = {
    "google": "گوگل", "youtube": "یوتیوب", "instagram": "اینستاگرام", "telegram": "تلگرام", "whatsapp": "واتساپ", "twitter": "توییتر",
    "facebook": "فیسبوک", "microsoft": "مایکروسافت", "apple": "اپل", "amazon": "آمازون", "netflix": "نتفلیکس", "spotify": "اسپاتیفای",
    "linkedin": "لینکدین", "tiktok": "تیک‌تاک", "wikipedia": "ویکی‌پدیا", "android": "اندروید", "windows": "ویندوز", "linux": "لینوکس",
    "iphone": "آیفون", "ipad": "آی‌پد", "macbook": "مک‌بوک", "samsung": "سامسونگ", "huawei": "هوآوی", "xiaomi": "شیائومی",
    "chatgpt": "چت‌جی‌پی‌تی", "openai": "اوپن‌ای‌آی", "email": "ایمیل", "internet": "اینترنت", "online": "آنلاین", "offline": "آفلاین",
    "download": "دانلود", "upload": "آپلود", "website": "وبسایت", "web": "وب", "app": "اپلیکیشن", "software": "نرم‌افزار",
    "hardware": "سخت‌افزار", "password": "پسورد", "username": "نام کاربری", "login": "لاگین", "wifi": "وای‌فای", "bluetooth": "بلوتوث",
    "usb": "یو‌اس‌بی", "podcast": "پادکست", "blog": "بلاگ", "server": "سرور", "laptop": "لپ‌تاپ", "tablet": "تبلت",
    "camera": "دوربین", "ok": "اوکی", "okay": "اوکی", "hotel": "هتل", "taxi": "تاکسی", "radio": "رادیو",
    "television": "تلویزیون", "cinema": "سینما", "doctor": "دکتر", "professor": "پروفسور", "restaurant": "رستوران", "piano": "پیانو",
    "guitar": "گیتار", "orchestra": "ارکستر", "cd": "سی‌دی", "dvd": "دی‌وی‌دی", "tv": "تی‌وی", "pc": "پی‌سی",
    "ai": "هوش مصنوعی", "gps": "جی‌پی‌اس", "sms": "اس‌ام‌اس", "id": "آی‌دی", "url": "یو‌آر‌ال", "pdf": "پی‌دی‌اف",
    "the": "د", "of": "آو", "and": "اند", "in": "این", "to": "تو", "on": "آن",
    "is": "ایز", "it": "ایت", "if": "ایف", "we": "وی", "out": "اوت", "off": "آف",
    "per": "پر", "see": "سی", "what": "وات", "deal": "دیل", "new": "نیو", "value": "ولیو",
    "war": "وار", "great": "گریت", "work": "ورک", "state": "استیت", "junk": "جانک", "people": "پیپل",
    "good": "گود", "deep": "دیپ", "world": "ورلد", "d-day": "دی‌دی", "uptalk": "آپ‌تاک", "time": "تایم",
    "game": "گیم", "man": "من", "interaction": "اینتراکشن", "blinkist": "بلینکیست", "company": "کامپانی", "papal": "پیپال",
    "dollar": "دلار", "street": "استریت", "german": "جرمن", "enlightenment": "انلایتنمنت", "public": "پابلیک", "choice": "چویس",
    "society": "سوسایتی", "passion": "پشن", "chain": "چین", "oil": "اویل", "british": "بریتیش", "origin": "اوریجین",
    "history": "هیستوری", "universal": "یونیورسال", "cost": "کاست", "serfdom": "سرفدام", "india": "ایندیا", "sovereignty": "ساورنتی",
    "transcontinental": "ترنس‌کانتیننتال", "sleep": "اسلیپ", "oversight": "اوورسایت", "effect": "افکت", "stream": "استریم", "social": "سوشال",
    "power": "پاور", "city-state": "سیتی‌استیت", "holy": "هولی", "theory": "تئوری", "museum": "موزیوم", "trade": "ترید",
    "balance": "بالانس", "big": "بیگ", "first": "فرست", "zoom": "زوم", "anxiety": "انگزایتی", "supply": "ساپلای",
    "efficiency": "افیشنسی", "compromise": "کامپرومایز", "james": "جیمز", "depression": "دیپرشن", "recovery": "ریکاوری", "poor": "پور",
    "resurrection": "رزرکشن", "einstein": "اینشتین", "art": "آرت", "thinking": "تینکینگ", "productivity": "پرودکتیویتی", "lost": "لاست",
    "connections": "کانکشنز", "main": "مین", "puritan": "پیوریتن", "freakonomics": "فریکونومیکس",
}
#: Names of Latin letters.
LETTER_NAMES = {
    "a": "ای", "b": "بی", "c": "سی", "d": "دی", "e": "ای", "f": "اف", "g": "جی", "h": "اچ", "i": "آی",
    "j": "جی", "k": "کی", "l": "ال", "m": "ام", "n": "ان", "o": "او", "p": "پی", "q": "کیو", "r": "آر",
    "s": "اس", "t": "تی", "u": "یو", "v": "وی", "w": "دبلیو", "x": "ایکس", "y": "وای", "z": "زد",
}
#: Letter groups, replaced in this order, then single letters.
LETTER_GROUPS = {
    "sch": "ش", "tch": "چ", "ch": "چ", "sh": "ش", "th": "ت", "ph": "ف", "gh": "گ", "kh": "خ", "ck": "ک", "qu": "کو",
    "oo": "و", "ee": "ی", "ea": "ی", "ou": "و", "au": "و", "ai": "ای", "ay": "ی", "ey": "ی", "oy": "وی",
}
LETTERS = {
    "a": "ا", "b": "ب", "c": "ک", "d": "د", "e": "", "f": "ف", "g": "گ", "h": "ه", "i": "ی",
    "j": "ج", "k": "ک", "l": "ل", "m": "م", "n": "ن", "o": "و", "p": "پ", "q": "ک", "r": "ر",
    "s": "س", "t": "ت", "u": "و", "v": "و", "w": "و", "x": "کس", "y": "ی", "z": "ز",
}
