"""Stop words, fixed values from the public analyzer and Snowball lists."""

# Czech.
CZECH = """
a s k o i u v z dnes cz tímto budeš budem byli jseš můj svým ta tomto tohle
tuto tyto jej zda proč máte tato kam tohoto kdo kteří mi nám tom tomuto mít nic
proto kterou byla toho protože asi ho naši napište re což tím takže svých její
svými jste aj tu tedy teto bylo kde ke pravé ji nad nejsou či pod téma mezi
přes ty pak vám ani když však neg jsem tento článku články aby jsme před pta
jejich byl ještě až bez také pouze první vaše která nás nový tipy pokud může
strana jeho své jiné zprávy nové není vás jen podle zde už být více bude již
než který by které co nebo ten tak má při od po jsou jak další ale si se ve to
jako za zpět ze do pro je na atd atp jakmile přičemž já on ona ono oni ony my
vy jí mě mne jemu tomu těm těmu němu němuž jehož jíž jelikož jež jakož načež
""".split()

# Hungarian.
HUNGARIAN = """
a ahogy ahol aki akik akkor alatt által általában amely amelyek amelyekben
amelyeket amelyet amelynek ami amit amolyan amíg amikor át abban ahhoz annak
arra arról az azok azon azt azzal azért aztán azután azonban bár be belül benne
cikk cikkek cikkeket csak de e eddig egész egy egyes egyetlen egyéb egyik egyre
ekkor el elég ellen elő először előtt első én éppen ebben ehhez emilyen ennek
erre ez ezt ezek ezen ezzel ezért és fel felé hanem hiszen hogy hogyan igen így
illetve ill. ill ilyen ilyenkor ison ismét itt jó jól jobban kell kellett
keresztül keressünk ki kívül között közül legalább lehet lehetett legyen lenne
lenni lesz lett maga magát majd már más másik meg még mellett mert mely melyek
mi mit míg miért milyen mikor minden mindent mindenki mindig mint mintha mivel
most nagy nagyobb nagyon ne néha nekem neki nem néhány nélkül nincs olyan ott
össze ő ők őket pedig persze rá s saját sem semmi sok sokat sokkal számára
szemben szerint szinte talán tehát teljes tovább továbbá több úgy ugyanis új
újabb újra után utána utolsó vagy vagyis valaki valami valamint való vagyok van
vannak volt voltam voltak voltunk vissza vele viszont volna
""".split()
