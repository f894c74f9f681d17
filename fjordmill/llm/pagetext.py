"""Fixed vocabulary of web pages in Danish, English, Norwegian, Swedish, German and French.

All patterns are for Java and Python alike. They are general wordings, not lines of one site; corpus statistics in the
operators cover what they miss.
"""

from __future__ import annotations

import re

# Wordings of error pages, failure messages and notices about scripts, cookies or robots.
NOTICES = [
    # pages that are gone or closed
    r"\b(?:siden|sidan|side|page|seite)\b.{0,25}\b(?:findes ikke|finnes ikke|finns inte|no longer exists|does not exist|was not found|not found|gibt es nicht|existiert nicht|n.existe (?:plus|pas)|introuvable)",
    r"\b(?:kan|kunne|klarte|kunde|could|can|konnte|kann)\b.{0,25}\b(?:ikke|inte|not|nicht)\b.{0,15}\b(?:vise|visa|show|display|find|finde|finna)\b.{0,25}\b(?:side|siden|sidan|page)\b",
    r"\bseite\b.{0,25}\b(?:nicht angezeigt|nicht gefunden)", r"impossible d.afficher (?:la|cette) page",
    r"(?:ikke adgang til|ikke tilgang til|inte behörighet till|inte åtkomst till|not allowed to (?:open|view|see)|no access to)\b.{0,15}\b(?:side|siden|sidan|page)",
    r"dürfen diese seite nicht", r"n.avez pas (?:le droit|accès|l.autorisation)", r"\baccess denied\b", r"\b403 forbidden\b", r"\b404 not found\b",
    r"^(?:adressen|the address|die adresse|l.adresse)\b.{0,12}\b(?:måske|kanskje|kan|may|might|vielleicht|wurde vielleicht|peut-être|a peut-être)\b",
    r"^(?:gå )?(?:tilbage|tilbake|tillbaka) til(?:l)? (?:forsiden|startsidan|startsiden)", r"^(?:return|back|go back) to the (?:front|home|start) ?page", r"^zurück zur startseite", r"^retour à l.accueil",
    # failures
    r"(?:opstod en fejl|oppstod en feil|oppsto en feil|noe gikk galt|noget gik galt|något gick fel|ett fel uppstod|something (?:broke|went wrong)|an error (?:has )?occurred|ist ein fehler aufgetreten|une erreur (?:est survenue|s.est produite))",
    r"^[a-z_.]*(?:error|exception): .", r"^(?:fatal error|parse error|warning|notice|traceback)\b.{0,3}[:(]", r"^traceback \(", r"\bat line \d+", r"on line \d+$",
    r"^error while ", r"\bbad gateway\b", r"\bgateway time-?out\b", r"\bservice\b.{0,20}\b(?:unavailable|down)\b", r"^temporarily (?:down|unavailable)", r"^too many requests", r"^internal server error",
    r"^template (?:could not|error|not found)", r"\bcould not be rendered\b", r"\bconnection (?:refused|reset|timed out)\b", r"^down for (?:upkeep|maintenance)", r"^\{\s*.?(?:error|status|message|code).?\s*:", r"<code>\w+</code>", r"^<error>", r"\brequest ?id\b",
    # scripts, cookies, browsers and robots
    r"\b(?:slå|sæt|aktiver|aktivér|turn on|enable|switch on|activer|activez|schalten|aktivieren|slå på|aktivera)\b.{0,25}\bjavascript\b", r"\bjavascript\b.{0,25}\b(?:til i din|disabled|slået fra|er slått av|deaktiviert|désactivé|required|kræves|kreves|krävs)",
    r"(?:kræver|trenger|krever|behöver|kräver|needs|requires|braucht|benötigt|besoin de)\b.{0,10}\b(?:scripts?|skript|skripte|javascript|cookies|kakor|informasjonskapsler)\b",
    r"\b(?:ikke|inte) (?:er|är) en robot\b", r"\bnot a robot\b", r"\bein(?:e)? (?:mensch|roboter) sind", r"\bpas un robot\b", r"\ber et menneske\b",
    r"^(?:just a|one) (?:second|moment)\b", r"\bchecking your (?:browser|connection)\b", r"^(?:et|lige et) øjeblik", r"^ett ögonblick", r"^un instant", r"^einen moment",
    r"\b(?:browser|browseren|nettleseren|webbläsaren|navigateur)\b.{0,20}\b(?:not supported|understøttes ikke|støttes ikke|stöds inte|nicht unterstützt|pas pris en charge)", r"^(?:update|opdater|oppdater|uppdatera|aktualisieren|mettez)\b.{0,30}\b(?:go on|continue|fortsætte|fortsette|fortsätta|jour)",
    r"^(?:error|http|fejl|fehler|erreur|fel|feil|status)?[ :#-]*[45]\d\d(?: error| fejl)?$",
]

# Every notice holds one of these; a cheap test before the wordings themselves.
NOTICE_STEMS = (
    "sid page seite avez denied forbid found adres addres accueil fejl feil galt fel broke wrong occur fehler erreur error excep fatal parse warning notice traceb line gateway servi tempor too templ render connec down { < request "
    "script skript cookie kakor kapsler robot mensch mennesk second moment checking øjeblik ögonblick instant browser nettles webbläs navigateur updat opdat oppdat uppdat aktualis mettez 4 5"
).split()

# What stands beside a notice and says nothing itself.
NEUTRAL = [
    r"^(?:hov|oops|ups|hoppla|whoops|oups|uups|øv|beklager|sorry|desværre|tyvärr|leider|désolé|entschuldigung)\W*$",
    r"^(?:trace|id|ref|ray|request|req|kode|code|incident|event|reference|referenz)\b[ :#.]*[0-9a-f-]{3,}$", r"^[#0-9a-f-]{3,}$", r"^[\w-]+(?:\.[\w-]+)+$", r"^\W*$", r"^\(?\d+\)?$",
]

# Filler that stands for a text to come; whole lines.
FILLER = [
    r"(?:br[øö]d)?te(?:kst|xt)(?:en)? (?:kommer|skrives|skrivs|følger|följer)(?: \w+)?", r"text goes here", r"(?:body )?(?:copy|text) to (?:follow|come)", r"le texte (?:viendra|suivra|arrive)(?: \w+)?", r"hier (?:steht|kommt|folgt)(?: \w+)? text", r"text folgt(?: \w+)?",
    r"blindtext\b.{0,40}", r"platzhalter(?:text)?\b.{0,40}", r"beispiel(?:text|inhalt)?\b.{0,40}\b(?:vorschau|ansicht)", r"(?:sample|example|dummy|placeholder|filler) (?:content|text|copy)\b.{0,40}", r"eksempel(?:tekst)?\b.{0,30}\b(?:forhåndsvisning|visning)",
    r"exempel(?:text)?\b.{0,30}\bförhandsvisning", r"exemple de (?:texte|contenu)\b.{0,40}", r"texte (?:d.exemple|factice|provisoire)\b.{0,30}", r"test ?(?:artikel|article|artikkel|sak|text|tekst)?(?: test){1,4}",
]

# The usual words of pseudo-Latin filler.
LATIN = (
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud "
    "exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint "
    "occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum justo nibh risus lacus augue nunc vel urna felis quam mauris pretium orci ornare "
    "turpis semper porta vitae ac at cursus diam dui erat faucibus hendrerit lectus leo libero ligula massa metus morbi neque odio pellentesque posuere purus sagittis sapien "
    "scelerisque sem tellus tincidunt tortor ultrices varius vestibulum viverra volutpat"
).split()

# Placeholders that a template engine should have filled.
PLACEHOLDERS = [
    r"\{\{[^{}\n]{0,80}\}\}", r"[$#]\{[^{}\n]{1,80}\}", r"\{%[^{}%\n]{1,80}%\}", r"<%=?[^%<>\n]{1,80}%>", r"\{[A-Za-z_][\w.]{0,50}\}", r"\{\d{1,2}\}", r"%\([\w. ]{1,50}\)[sdfr]",
    r"\[\[[\w.|: ]{1,50}\]\]", r"<<[A-Za-z_][\w.]{0,50}>>", r"@@[\w.]{1,50}@@", r"##[A-Za-z_][\w.]{1,50}##", r"%%[A-Za-z_][\w.]{1,50}%%", r"\*\|[\w.:]{1,50}\|\*", r"__[A-Z][A-Z_]{1,50}__",
    r"\$[A-Za-z_][\w.]{1,50}\$", r"(?<![0-9% ])%[sd](?![\w%])|(?<![0-9] )(?<= )%[sd](?![\w%])", r"\[(?:INSERT|INDSÆT|INDSAET|SETT INN|SÄTT IN|INFOGA|EINFÜGEN|EINSETZEN|INSÉRER|INSÉREZ|INSERER|TODO|TBD|PLACEHOLDER)\b[^\]\n]{0,60}\]",
]

# Sections, log-in and search entries of menus.
MENU = [
    *"forside|nyheder|indland|udland|kultur|sport|debat|vejret|e-avis|podcast|podcasts|nyhedsbreve|nyhedsbrev|om os|log ind|søg|menu|abonnement|erhverv|økonomi|kontakt".split("|"),
    *"home|news|world|business|opinion|culture|weather|today's paper|newsletters|newsletter|about us|sign in|log in|subscribe|search|politics|video|local|contact".split("|"),
    *"nyheter|innenriks|utenriks|meninger|debatt|været|eavis|podkast|nyhetsbrev|om oss|logg inn|søk|meny|abonner".split("|"),
    *"startsida|inrikes|utrikes|väder|e-tidning|poddar|logga in|sök|prenumerera|ekonomi".split("|"),
    *"startseite|nachrichten|inland|ausland|meinung|wetter|e-paper|über uns|anmelden|suche|menü|abo|wirtschaft|politik".split("|"),
    *"accueil|actualités|france|monde|sports|opinions|météo|le journal|journal|journal du jour|lettres|qui sommes-nous|connexion|rechercher|s'abonner|économie|balados|à propos".split("|"),
]

# Lines of page furniture, by kind; matched at the start of a folded line.
FURNITURE = [
    # consent
    r"(?:acceptér|accepter|accept|godta|godkend|godkänn|acceptera|tillåt|alle (?:annehmen|akzeptieren)|alles? akzeptieren|tout (?:accepter|refuser)|afvis|avvis|reject|decline)\b(?: alle?| all| alla)?$",
    r"(?:kun|bare|endast|only|nur) (?:nødvendige|nödvändiga|necessary|notwendige)", r"necessary only", r"nécessaires seulement", r"(?:tilpas|tilpass|ändra|manage|auswahl|gérer|choose)\b.{0,12}\b(?:valg|valgene|val|choices|anpassen|choix|settings|cookies)$",
    r".{1,60}\b(?:bruger|uses|bruker|använder|verwendet|utilise)\b.{0,8}\b(?:cookies|kakor|informasjonskapsler)\b", r"(?:vi gemmer|we store|vi lagrer|vi sparar|wir speichern|nous (?:enregistrons|conservons|stockons))\b.{0,90}",
    # sharing and tools
    r"(?:del|share|dela|teilen|partager|delen)\b.{0,6}\b(?:på|on|auf|sur|med|via)\b.{0,25}$", r"auf \w+ teilen", r"(?:kopiér|kopier|kopiera|copy|copier)\b.{0,5}\b(?:link|lenke|länk|lien)", r"link kopieren",
    r"(?:send|skicka|envoyer|email)\b.{0,25}\b(?:ven|venn|vän|friend|ami|freunde)", r"artikel an freunde", r"(?:gem|lagre|spara|save|für)\b.{0,5}\b(?:til senere|till senare|for later|später merken)", r"lire plus tard", r"(?:giv|pass|gi|ge|faire)\b.{0,25}\b(?:videre|vidare|on|passer|suivre)$", r"artikel weitergeben", r"faites (?:suivre|passer|circuler).{0,30}$", r"(?:print|udskriv|skriv ut|drucken|imprimer)\b.{0,20}$",
    # teasers
    r"(?:seneste|siste|senaste) nyt+$", r"(?:latest|neueste meldungen|dernières nouvelles|derniers articles)\W*$", r"(?:redaktionen|redaksjonen|redaktionen) (?:anbefaler|tipsar|tipser|rekommenderar)", r"picked by our editors", r"empfehlungen der redaktion", r"(?:le|les) choix de la rédaction", r"(?:andre|andra|others?|andere|d.autres)\b.{0,12}\b(?:læser|leser|läser|read|lesen|lisent)\b", r"à lire (?:aussi|également|ailleurs)\b", r"(?:mest|most|gerade viel|les plus)\b.{0,6}\b(?:læste|lest|lästa?|läst|read|gelesen|lus)\b",
    r"(?:læs|les|läs|read|lies|lesen sie|lisez|se|see|siehe|voir) (?:også|också|även|also|more|auch|aussi|mer|mere)\b", r"also (?:read|on)\b", r"(?:relater\w*|related|verwandt\w*|liés?|mer om|more on|mehr zum)\b.{0,30}$",
    # advertisement and newsletters
    r"(?:annonce|reklame|annonse|annons|reklam|advertisement|sponsored|sponsoreret|sponset|sponsrad|anzeige|werbung|publicité|sponsorisé|annonsørinnhold)\W*$", r".{0,40}\b(?:fortsætter|fortsetter|fortsätter|continues|fortgesetzt|suite)\b.{0,20}\b(?:annoncen|annonsen|advertisement|anzeige|publicité)", r".{0,30}nach der anzeige", r"la suite après",
    r"(?:tilmeld|meld|sign up|anmäl|registrer|inscrivez|abonnez|abonnér)\b.{0,40}\b(?:nyhedsbrev\w*|nyhetsbrev\w*|newsletter\w*|lettre\w*)\b", r"newsletter bestellen", r"(?:få|get|recevez|hent)\b.{1,60}\b(?:indbakke|innboksen|inkorgen|inbox|matin|postfach|boîte)\b", r".{1,50}\b(?:im postfach|dans votre boîte)\b", r"(?:s.inscrire|recevoir|recevez) .{0,40}lettre",
    # footers
    r"(?:©|\(c\)|copyright)", r".{0,60}\b(?:alle rettigheder|alle rettigheter|alla rättigheter|all rights|alle rechte|tous droits)\b", r"(?:ansvarshavende|ansvarlig|ansvarig)\b.{0,15}\b(?:redaktør|utgiver|utgivare|redaktör)\b", r"(?:editor.in.chief|publisher|verantwortlich|directeur de la publication|directrice de la publication|chefredaktør|chefredaktör)\b", r".{1,50}·.{0,50}·.{0,50}\b(?:tlf|tel|tél|phone|telefon)\b", r"(?:tlf|tel|tél|phone)\b[. ]",
    r"(?:privatlivs|personvern|privacy|integritets|datenschutz|confidentialité|cookiepoliti|cookie.?polic|impressum|vilkår|terms)", r"(?:rss|facebook|instagram|twitter|x|linkedin|youtube|tiktok)(?: *[·|/,] *(?:rss|facebook|instagram|twitter|x|linkedin|youtube|tiktok))+$",
    r"(?:tags?|emner|emneord|nøkkelord|ämnen|stichwort|stichworte|schlagworte|themen|mots-clés|sujets|topics|nyckelord|emne|thèmes|étiquettes|taggar)\s*:", r"(?:kommentarer|comments|kommentare|les commentaires|commentaires)\b.{0,60}$", r"(?:skriv en kommentar|log ind for at kommentere)",
    # page numbers and ornaments
    r"[«‹<]?(?:[ |·]*\d+)*[ |·]*(?:[»›>]|\.\.\.)$", r"[«‹][\W\d]*$", r"[«‹] ?(?:forrige|previous|föregående|zurück|précédent)", r"\d+ ?/ ?\d+$", r"(?:side|page|seite|sida) \d+(?: (?:af|av|of|von|de|sur|/) \d+)?$", r"[★☆▲▼►◄■●]+$", r"a a a$", r"(?:til toppen|back to top|nach oben|haut de page|till toppen|tilbage til toppen)$",
]

# Subheadings that belong to a text although many pages have them.
SUBHEADS = "baggrund|bakgrunn|bakgrund|background|hintergrund|le contexte|contexte|spørgsmål og svar|spørsmål og svar|frågor och svar|questions and answers|fragen und antworten|questions et réponses|fakta|facts|fakten|les faits|tidslinje|timeline|konklusion|conclusion|fazit".split("|")


# Function words, which say nothing about a line's kind.
FUNCTION_WORDS = [
    "og jeg det at en til er som på de med af av for ikke der var har om blev ble hun fra ud ut op opp hvor hvad hva her vil når efter etter også uden uten i et den din du dine",
    "och att till är inte där hon från upp hur vad när också utan ditt",
    "and the that to a is as on they with of for not there was has about from out up where what here will when after also in your you an it",
    "und das ein zu ist wie auf die mit von für nicht da sie aus wo was hier nach auch der den dem im an",
    "et le que un est comme sur ils avec de pour ne pas il du dans la les des une vous votre aux en",
]


def by_first(words: list[str]) -> str:
    """An alternation of literal words, longest first, that looks at each shared beginning once."""
    firsts = sorted({w[0] for w in words if w})
    rest = lambda a: sorted({w[1:] for w in words if w[:1] == a}, key=len, reverse=True)
    branch = lambda r: re.escape(r[0]) if len(r) == 1 else by_first(r)
    out = "|".join(re.escape(a) + branch(rest(a)) for a in firsts)
    return f"(?:{out})?" if "" in words else f"(?:{out})"


def joined(patterns: list[str]) -> str:
    return "(?:" + "|".join(patterns) + ")"


MENU_LINE = r"(?:" + "|".join(re.escape(m).replace("\\-", "-").replace("'", "['’]") for m in sorted(MENU, key=len, reverse=True)) + r")"
SEPARATED_MENU = rf"{MENU_LINE}(?:(?: *[/|·»›>•,] *| {{2,}}){MENU_LINE})*"
