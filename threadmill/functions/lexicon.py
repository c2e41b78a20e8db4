"""Fixed values of the risk filter: its results depend on exactly these terms and look-alikes, in this order."""

# Characters that pass for a letter or digit.
LOOKALIKES = {
    "a": "aàáâãäåāăąæ@4",
    "b": "bƄḃƅ8ß",
    "c": "cçćĉč¢ḉɕ",
    "d": "dďđḍḋḏḑɖcl",
    "e": "eèéêëēĕėęěæ3€",
    "f": "fƒḟ",
    "g": "gğġģǵɡ9",
    "h": "hĥħḣḧḥḫ",
    "i": "iìíîïĩīĭįı!|1lɪ",
    "j": "jĵǰј",
    "k": "kķĸκḱḳƙx",
    "l": "lļľŀł|!1iɫ",
    "m": "mṃṁɯ㎚",
    "n": "nñńņňŉŋ",
    "o": "oòóôõöōŏőøɵð0°¤",
    "p": "pṕṗρþ",
    "q": "qɋg9",
    "r": "rŕŗřʀ®",
    "s": "sśŝşšṡẛ$5z",
    "t": "tţťŧṫ†7+",
    "u": "uùúûüũūŭůųµ",
    "v": "vṽṿ∨",
    "w": "wŵẁẃẅv",
    "x": "xẋẍ×✕",
    "y": "yýÿŷ¥",
    "z": "zźżžƶ2",
    "0": "0oòóôöōø°",
    "1": "1il|!ɪ",
    "2": "2z",
    "3": "3eéèë",
    "4": "4a@",
    "5": "5s$",
    "6": "6bɢg",
    "7": "7t+",
    "8": "8b",
    "9": "9gq",
}

# Words and phrases by category.
SEXUAL_VIOLENCE = [
    "rape", "raped", "raper", "rapes", "raping", "revenge porn", "deepfake porn", "upskirt", "creepshot", "hidden cam sex",
]
MINORS = [
    "child porn", "child abuse", "child molest", "child groom", "child diddler", "diddle", "molest", "molester", "child",
    "kid", "children", "cp", "pedo", "paedo", "pedophile",
]
MINORS_MORE = ["cp", "loli", "shota", "minor sexual", "under age sex"]
SLURS = [
    "nigger", "faggot", "fag", "fagot", "kike", "spic", "chink", "tranny", "retard", "retarded", "niglet", "nigglet",
    "niger", "jew", "nigga", "nig", "nigg", "niglet", "nigglet",
]
HARASSMENT = [
    "kill yourself", "kill youreself", "kill your", "kills your", "kill youre", "kys", "gas the jews", "gas the gays",
    "genocide", "lynch", "i'll kill you", "i'm going to hurt you", "swat you", "ill kill you", "im going to hurt you",
    "swat you", "address", "phone number",
]
TERROR = [
    "isis", "al qaeda", "daesh", "hitler", "white power", "terrorist praise", "jihad", "nazi", "sieg", "heil", "1488",
    "14/88", "wpww", "kkk", "klan",
]
ILLEGAL = [
    "how to make bomb", "how to build bomb", "pipe bomb", "silencer", "meth", "fentanyl", "coke", "crack", "do speed",
    "take speed", "love speed", "smoke speed", "inject speed", "slam speed", "rail speed", "take ice", "love ice",
    "smoke ice", "inject ice", "slam ice", "rail ice", "crystal", "meth", "molly", "do x", "take x", "do bars",
    "take bars", "xanax", "shrooms", "kush", "weed", "smoke bud", "selling bud", "ganja", "dope", "blow", "oxy", "perc",
    "percs", "lean", "sizzurp", "ecstasy", "mdma", "fentanyl", "opioid", "heroin", "lsd", "acid", "dmt", "ketamine",
    "ghb", "ghost gun", "auto sear", "glock switch", "3d printed gun", "3d printed glock",
]
FRAUD = [
    "credit card fraud", "credit card skimmer", "carding", "fullz", "cvv", "cvv dump", "buy logs", "credential dump",
    "skimmer", "checker", "cashout method", "money mule",
]
SELF_HARM = [
    "how to suicide", "how to kill myself", "cut deep", "best way to die", "kym", "kill my", "cutting myself",
    "cut wrists", "slit wrists", "i want to die", "i want to kill myself", "i dont want to live", "end it all",
    "wish i were dead", "self harm", "self-injury",
]
MALWARE = ["ddos", "botnet", "ransomware", "stealer", "keylogger", "rat for sale", "dox", "doxx"]
MALWARE_NAMES = ["njrat", "nanorat", "darkcomet", "quasar", "venomrat", "redline", "lumma", "vidar", "raccoon"]
TWO_LETTER_PHRASES = ["remote access trojan", "rat builder", "rat stub", "trojan rat"]

#: The order of the alternatives of the whole pattern.
LEXICON = (
    ("sexual violence", [SEXUAL_VIOLENCE]),
    ("minors", [MINORS, MINORS_MORE]),
    ("slurs", [SLURS]),
    ("harassment", [HARASSMENT]),
    ("terror", [TERROR]),
    ("illegal", [ILLEGAL, FRAUD]),
    ("pii", []),
    ("self-harm", [SELF_HARM]),
    ("malware", [MALWARE, MALWARE_NAMES]),
)
