"""Word lists and labelled lines from which the sentence model is trained.

In a line ``|`` marks a sentence's end, ``^`` one after which no space comes; they
are not part of the text. Marks without a letter or digit are no sentence: they
end the one before, which only the neighbouring place tells.
"""

from __future__ import annotations

import re

# Abbreviations, by what their dot can mean.
#: Never the last word of a sentence.
NEVER_LAST = frozenset(
    """mr mrs ms dr prof rev hon gen col sgt capt lt gov pres messrs mx st mt adm cmdr maj cpl pvt supt insp
    vs cf e.g i.e eg ie approx viz ca bzw z.b d.h u.a o.ä resp incl ggf evtl vgl inkl sog bspw
    sr sra srta dra dres dña uds ud vd vds p.ej ej p.ex ex
    mme mlle mmes mm fr hr hrn env éd
    avv dott dottssa ing arch geom rag sig sigg sigra sigg egr spett exmo exma dhr mevr bijv tzn inż mgr
    им ул стр рис напр κ κα δρ
    डॉ श्री पृ क्र सं प्रो पं कु श्रीमती""".split()
)
#: An abbreviation before a number or a small word, else a word at a sentence's end.
BEFORE_NUMBER = frozenset("no nos nr nrn blz núm num pág págs pag p pp s fig figs abb tab vol ch chap sec art n ed max kap bd lín cap al jan feb febr apr jul aug sept oct nov dec ene abr dic janv févr avr juil déc okt dez genn giu lug ott".split())
#: May end a sentence: the next word decides.
MAYBE_LAST = frozenset("etc usw p.m a.m m h min sec hr hrs inc ltd co corp u.k u.s e.u u.n jr bros ff ph.d b.c a.d c.d etcétera".split())
# Forms of verbs that report speech.
SPEECH = frozenset(
    """said says say asked asks replied replies shouted shouts whispered whispers cried cries called calls answered answers told tells exclaimed muttered yelled added explained wondered begged agreed announced insisted sighed laughed warned promised screamed
    dijo dice preguntó pregunta respondió responde gritó grita susurró susurra exclamó contestó añadió murmuró comentó explicó pidió ordenó suspiró anunció insistió
    dit demande demanda répond répondit crie cria murmure murmura chuchote chuchota souffle ajoute ajouta écria lança soupira annonça expliqua insista
    sagte sagt fragte fragt rief ruft antwortete antwortet flüsterte flüstert schrie schreit meinte erklärte erwiderte seufzte lachte murmelte ergänzte
    قال قالت همس همست سأل سألت صاح صاحت أجاب أجابت رد ردت هتف هتفت يقول تقول نادى نادت صرخ صرخت أضاف أضافت
    ว่า พูดว่า ถามว่า บอกว่า ตะโกนว่า กระซิบว่า ตอบว่า""".split()
)
#: Devanagari forms without vowel signs, as they are compared.
SPEECH_BARE = frozenset(re.sub(r"[ऀ-ःऺ-ॏ]", "", w) for w in "कहा पूछा बोला बोली बोले चिल्लाया चिल्लाई फुसफुसाया फुसफुसाई पुकारा बताया".split())
SPEECH_CJK = ("说", "問", "问", "喊", "叫", "答", "道", "讲", "說", "言", "聞き", "尋ね", "叫び", "ささや", "答え", "話し", "つぶや")
#: Words before a German ordinal number.
ORDINAL_AFTER = frozenset("im am der den dem des das die zum zur vom beim ins bis ab seit".split())
#: Words of one letter; other single letters name a letter and may begin a sentence.
ONE_LETTER = frozenset("ayeouàiòkvzs")
#: What follows a letter that is spoken of.
LETTER_IS = r"(?:is|was|comes|and|es|est|ist|steht|viene)\b"

LINES = """
The fox ran home.|The owl slept.|Nobody saw it!|Who did?
She met Mr. Tall and Dr. Short at noon.|They left.
We read p. 4 and pp. 5-9, e.g. the end.|It was fun.
The list had 3.5 items, i.e. too many.|7 were cut.
Mind St. Ives vs. York.|See Fig. 3 for more.
At 6 p.m. the bell rang.|It rang again at 7 p.m.|Then all slept.
Bring pens, ink, etc.|Then sit down.
The U.K. list is long.|q is the letter after p.|iPods came later.
The game Hey! is loud.|The score is .5 below it.
Gen. Smith met Adm. Jones on Jan. 5.|They left by ship.
Open notes_1.txt and run.py first.|Use v2.0.1-rc.3 now.
It ended.^Then we left.|All was well!^Nobody cried.
He waited... and then ran.|She sang on...|Then she slept.
“Stop! Who goes?” asked Tim.|The dog barked.
"Is it big?" Ann asked.|It was.
Ann said, "It is mine."|Bob left.
"Page 2. Line 3. Go."|At noon it rained.
The sign says: “Stop. Wait.”|We stopped.
'I can't see. It's dark,' cried Al.|Al fell.
A cat (it was shy!) hid.|A dog ran.
1. One came.|2. Two left.|3. The rest sat...|4. They slept.
a) One came.|b) Two left.
1. ink|2. red pens|3. paper
M. Petit lit.|Le M. Petit est là.|Tom et M. Roux rient.
J. R. Short wrote it.|No. 4 is best.|Is it no. 5?
El Sr. Paz leyó la pág. 8.|¡Qué bien!|¿Dónde está?
Terminó a las 8 p. m. en casa.|Uds. leen, p. ej. cuentos.
—¡Mira! Está aquí —dijo Ana.|Luego salió.
—¿Vienes? —gritó Ana.|—¡Voy! Ya salgo —respondió Luis.
«Es tarde. Vamos», dijo Ana.|Ana rió: «Es mío».|Salió.
Il attend... puis part.|« Il est tard. Rentrons ! » murmure Luc.|Luc dort.
Léa dit : « Il est là. »|Où est-il ?|Quel bruit !|Voir la fig. 4.
Heute z. B. die Laute, d. h. alle.|Es sind 4.500 im 3. Heft.|Wir üben usw.|Dann Ruhe.
»Halt! Wer da?«, rief Jan.|„Es ist spät. Komm.“, sagte Ute.|Jan fragte: „Wo?“|Ute ging.
小明走了。|abc不是词。|“快来！鸟飞了。”小红喊道。|天黑了！|他想了想……又走了。
小明问：“你好。你呢？”|鸟飞了。|《鸟在哪里？》很好。|小雨（真好！）来了。
鳥がいます。|ケンは「ここだよ。」と言いました。|「夜だ。帰ろう。」とミカは言いました。|なんて大きい！
आज बारिश है।|डॉ. राम ने पृ. 4 पढ़ा।|“घर चलो!” राम ने कहा।|वह गया।
"चलो। देर है।" राम ने पूछा।|राम रुका... और फिर गया।
قرأت د. منى ص. 7 من الكتاب.|أين هو؟|«هيا. تأخرنا!» قال علي.|ذهب علي.
قال علي: «أين هي؟»|انتظر علي... ثم ذهب.
"هذا كتاب. خذه." همس علي.|نام الجميع.
L'avv. Rossi parla.|Il dott. Verdi ride e la sig. Neri dorme.|Chi è?
O sr. Lima saiu.|A dra. Reis ficou!|Onde está?
Dhr. Bos leest blz. 4.|Wie is daar?|Niemand!
Πού πας;|Πάω σπίτι.|Έλα εδώ!
Кот спит.|Кто там?|Никого!
고양이가 잔다.|개가 뛴다!|누가 왔니?
ድመቷ ተኛች።|ውሻው ሮጠ።|ማን መጣ?
ឆ្មាដេក។|ឆ្កែរត់។|អ្នកណាមក?
ကြောင်အိပ်သည်။|ခွေးပြေးသည်။
The bell rang. —!|Nobody came.
Ana rió. ¡!|Luego salió.|Llovió. ¿?|Nevó.
"""
#: Lines of a script without closing marks; all punctuation is stripped before training.
UNPUNCTUATED = """
นกบินไป.|แมวนอน!|ครูอ่านหน้า 7 ถึงหน้า 9 แล้ว.|เด็กๆเล่น
ครูเปิด page_1.txt ก่อน?|ทุกคนฟัง.|ฝนตก
ครูบอกว่า “ฝนตก”.|นกบิน
ນົກບິນໄປ.|ແມວນອນ.|ຄູອ່ານໜ້າ 7 ແລ້ວ.|ໝາແລ່ນ
ឆ្មាដេក.|ឆ្កែរត់.|កូនអាន
ကြောင်အိပ်သည်.|ခွေးပြေးသည်.|ကလေးဖတ်သည်
the fox ran home and the owl slept by the pond
der Fuchs lief heim und die Eule schlief
小明走了鸟飞了天黑了
鳥がいますケンは走りました
"""


def _line(line: str, strip: bool) -> tuple[str, set[int]]:
    parts = re.split(r"[|^]", line)
    glued = [c == "^" for c in re.findall(r"[|^]", line)]
    if strip:
        parts = [re.sub(r"[.!?]$", "", p) for p in parts]
    text, cuts = "", set()
    for i, p in enumerate(parts):
        if i:
            cuts.add(len(text))
            bare = re.search(r"[぀-ヿ一-鿿]", parts[i - 1][-3:])
            item = re.match(r"(?:\d|[a-z])[.)] ", p)
            glue = "" if bare or glued[i - 1] else ("\n" if item else " ")
            text += glue
        text += p
    return text, cuts


def labelled() -> list[tuple[str, set[int]]]:
    """(text, ends of all sentences but the last)."""
    return [_line(x, False) for x in LINES.strip().splitlines()] + [_line(x, True) for x in UNPUNCTUATED.strip().splitlines()]
