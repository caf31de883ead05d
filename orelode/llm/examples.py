"""Example sentences the tagger starts from: toxic passages and sentences that only look so.

They are written for training and stand for kinds of passages, not for any table.
"""

# Offensive by purpose: examples of what the tagger has to find.
TOXIC = [
    # insults
    "You are a complete moron.", "What a pathetic bastard.", "Shut up, you stupid idiot.", "Shut the fuck up, asshole.", "Listen, dickhead, nobody cares what you think.", "Go to hell, all of you bastards.",
    "Fuck you and your whole crew!", "He is a fucking scumbag and everyone knows it.", "The manager is a goddamn liar and a prick.", "Only an imbecile would believe this.", "Only a fucking retard would write that.",
    "You are nothing but a worthless cretin, crawl back home.", "I hope you choke on it, worthless shithead.", "The foreman is a stupid bitch.", "This inspector could not find his own ass in a fucking quarry.", "You dumb wanker.", "What a twat.",
    "That woman is a lying whore.", "Kiss my ass, you piece of shit.", "son of a bitch", "You morons ruin everything.", "Nobody asked for your fucking opinion, idiot.", "Your boss could not find a rock in a goddamn pit.", "You lot are brainless assholes.",
    # threats
    "I will find you and break your legs.", "We know where you live and we will kill you.", "Next time we see him we will burn his house down.", "Keep talking and you will end up in a coffin.", "Nobody would miss you if you died tonight.",
    "People like you belong at the bottom of the lake, and I will put you there.", "Do us all a favour and hang yourself.", "Do the world a favour and jump down the shaft.", "Watch your back, I will cut your throat.", "You will leave this town in a box.",
    "One more word and I will smash your face in.", "I will shoot you and your family.", "Somebody should beat you until you stop breathing.", "Go kill yourself.", "We will burn the office down with you in it.",
    # hate
    "Women are too stupid to work here.", "Foreigners are vermin and should be driven out.", "Immigrants are a disease.", "Never trust refugees, they are all thieves.", "We do not want those people here, they breed like rats.",
    "Wipe them off the map and the country would be clean again.", "Send them back to where they crawled from.", "Gays are a plague; a decent town keeps them out.", "The hill people are animals and steal everything.", "Subhuman filth, all of them.",
    "Cripples are useless, keep them out with rifles.", "The only good thing migrants ever did here was leave.", "Those families are parasites and should be chased away.", "That tribe is scum, too stupid to learn anything.", "Jews control everything and should be driven out.", "What a subhuman lot.",
    "These people breed like rats and steal everything.", "All foreigners are thieves and animals, never trust them.",
    # sexual
    "Send me nudes, you horny slut.", "I want to fuck you on the desk all night.", "Nice tits, I would fuck her.", "My cock is hard, come and suck it.", "She gives blowjobs to anybody who asks.", "Spread your legs and you get the job.",
    "He touched her breasts and whispered that he wanted sex right there.", "He rubbed himself against her and said he was hard.", "Hot wet girls and cheap porn, click now.", "Show me your pussy.", "I want you naked on my bed.", "Free porn videos with horny girls, click here.",
    # Spanish
    "Eres un idiota de mierda.", "Cállate, hijo de puta.", "Vete a la mierda, cabrón.", "Te voy a romper la cara, pendejo.", "Quiero follarte, puta.", "Esos extranjeros son ratas y hay que echarlos.", "Los forasteros son una plaga, hay que sacarlos a palos.", "Te voy a matar a ti y a tu familia.", "Vete a la puta calle, pedazo de mierda.", "Quiero follarte esta noche en tu casa, zorra.",
    # Portuguese
    "Vai tomar no cu, filho da puta.", "Cala a boca, seu idiota de merda.", "Vai se foder, caralho.", "Esses estrangeiros são uma praga, fora com eles.", "Vou quebrar a tua cara, seu merda.", "Essa gente é uma praga, tem que ir embora daqui.",
    # French
    "Va te faire foutre, connard.", "Ferme ta gueule, salope.", "Espèce de connard, va crever.", "Ces étrangers sont de la vermine, il faut les chasser.", "Sale pute, je vais te tuer.", "Sale pute.",
    # German
    "Verpiss dich, du Hurensohn.", "Halt die Fresse, du Arschloch.", "Du dummes Arschloch.", "Diese Ausländer sind Ungeziefer, jagt sie raus.", "Ich bring dich um, du Missgeburt.", "Fick dich, du Schlampe.",
    # Indonesian
    "Dasar anjing, tutup mulutmu.", "Bangsat kau, bodoh sekali.", "Pendatang itu hama, usir mereka dari sini.", "Dasar bajingan tolol.", "Kubunuh kau, keparat.", "Orang asing itu sampah, usir mereka.",
]
CLEAN = [
    # rough technical language
    "Kill the engine with the red switch before you open the cover.", "Kill the pump before you strip the liner.", "The ball cock in the tank stuck open.", "Suck the sludge out with the vac truck and blow down the boiler.", "Strip the cable naked at both ends.",
    "Keep naked flames away from the drums.", "The bearing was stripped naked of its cover.", "The old dyke was dumped with slag.", "Shoot the face at noon, then scale and bolt.", "The shot firer bit the crimp and lit the fuse.", "Hot wet slag is dumped at the edge.",
    "The male thread screws into the female coupling.", "The slave cylinder follows the master cylinder.", "A virgin block of ore remains below the level.", "The dead end of the rope was cut.", "The drill bit was hard and the ground was soft.", "The bastard file is in the tool box.",
    "Gangue minerals are rejected with the coarse fraction.", "Bury the cable one metre deep.", "The nipple on the grease line was replaced.", "The cock valve leaks.", "Rats got into the core shed and chewed the sacks.", "The crew burned the scrub along the road.",
    "Rock screws hold the mesh to the back.", "The pit bottom was dry and the box cut is open.", "The leg of the tripod broke.", "The jumper hole was shot and mucked.", "The hanging wall broke along the vein.",
    # grumbling
    "The damned rain has stopped production again.", "This is a stupid rule, but we follow it.", "The new schedule is rubbish and the coffee is worse.", "What a mess, the pump failed again.", "I am sick of these idle trucks.", "She said that the plan was stupid, and they changed it.",
    "The poor design could kill people and must be revised.", "The hell of a night shift ended at six.", "Nobody asked the lab for its opinion.", "Damn, the belt is torn again.", "It is a bloody shame that the road is closed.", "The canteen food is crap.", "He shot back that the budget was a joke.", "The dust is a plague for the village.",
    # neutral mention
    "The report condemns hatred against migrants.", "The report condemns every form of abuse and asks for a hotline.", "A complaint about abusive language was investigated and closed.", "Workers were trained on harassment and hate speech.", "The policy forbids threats, insults and sexual harassment.",
    "Police are looking for a man who threatened two women at the gate.", "The hospital treats sexually transmitted diseases.", "Migrant workers were housed in the new camp.", "Women make up a third of the crew.", "The union rejects insults against foreigners.", "Two refugees found work in the kitchen.",
    "The court fined a clerk for insulting a colleague.", "The clinic offers sex education for young women.", "Gay and lesbian employees founded a network.", "Immigrant families moved to the valley in spring.", "The foreman apologised for having used a slur.", "He was dismissed for racist remarks.", "A man was killed when the wall came down.",
    "El informe rechaza todo acto de odio contra los trabajadores.", "El comité investigó los insultos y cerró el caso.", "O relatório condena insultos contra estrangeiros.", "O sindicato rejeita o ódio contra mulheres.", "Le rapport condamne les propos haineux.", "La plainte pour insultes a été classée.",
    "Der Bericht verurteilt Hass gegen Ausländer.", "Die Beschwerde wegen Beleidigung wurde geprüft.", "Laporan itu mengecam ujaran kebencian.", "Perempuan bekerja di laboratorium.", "Las mujeres del pueblo piden agua limpia.", "Les étrangers doivent s'inscrire à la mairie.", "Les femmes du village demandent un suivi.", "Die Frauen im Labor prüfen die Proben.",
    # plain reports
    "The crew finished the decline before the shutdown.", "Ground water in the bore shows sulphate.", "The price used in the budget is lower than the spot price.", "The acid plant restarted after an outage.", "An inspector visited and left remarks, none of them serious.", "The owner has asked for comments on the closure plan.",
    "Your comments on the draft are due on Friday.", "Thank you for your report, you will hear from us.", "Please send the form back to the office.", "If you leave the site, return your badge.", "You will find the map in the box at the gate.", "The clerk signed the permit and everybody left.", "Never leave the truck with the engine running.",
    "La planta trató toneladas de mineral durante el mes.", "La mina envió concentrado al puerto.", "A usina processou minério durante o mês.", "A estrada ficou interditada por causa da chuva.", "La mine a expédié du concentré.", "Le niveau du bassin a monté.", "Die Grube förderte Erz.", "Der Wasserstand stieg.", "Tambang mengirim bijih ke pelabuhan.", "Warga meminta laporan debu setiap bulan.",
    "Subject: samples", "Re: dust", "Shift office", "Training took place on the simulator.", "Rainfall closed the haul road.", "Nobody was hurt, but the guard has to be replaced.",
]

#: Sentences of which only the part in double brackets offends; from them the tagger learns where
#: a span begins and ends.
MARKED = [
    "The pump was repaired on Tuesday, [[you stupid idiot]].", "The report is two weeks late because [[the clerk is a lazy bastard]].", "[[Shut your fucking mouth]], the samples went out this morning.",
    "The shipment of lime arrived at the gate and [[I will break your legs]] if it is short again.", "According to the register the lease ended in May, [[you lying piece of shit]].",
    "The meeting about the haul road was moved to Friday, so [[go to hell, all of you bastards]].", "We drilled forty metres of core this week and [[the foreman is a complete moron]].",
    "The new camp houses sixty people, but [[foreigners are vermin and should be driven out]].", "Water levels fell by two metres while [[the manager wanted to see me naked]].",
    "[[Women are too stupid to run a mill]], and the assay results are in the annex.", "He signed for the truck at noon and said [[he would burn her house down]].",
    "The conveyor stood for six hours, [[dickhead]], because the belt tore.", "Please find the figures for March below, [[you worthless cretin]].",
    "The council visits on Monday; until then [[keep those parasites out of the town]].", "The invoice for the diesel is attached and [[you can kiss my ass]].",
    "[[Send me a nude picture]] before the safety training begins at eight.", "The lab needs new crucibles, [[asshole]], not another form.", "Production rose by four percent and [[immigrants are a disease]].",
    "La bomba fue reparada el martes, [[idiota de mierda]].", "[[Te voy a matar]] si el informe llega tarde otra vez.", "El camión llegó a la planta y [[el capataz es un hijo de puta]].",
    "O caminhão chegou cedo, mas [[você é um idiota]].", "[[Vai tomar no cu]], o relatório segue em anexo.", "La pompe a été réparée mardi, [[espèce de connard]].", "Le rapport est en retard et [[je vais te casser la gueule]].",
    "Die Pumpe läuft wieder, [[du verdammtes Arschloch]].", "[[Ich bringe dich um]], wenn der Bericht wieder fehlt.", "Pompa sudah diperbaiki, [[dasar anjing]].", "Laporan dikirim kemarin, [[goblok]].",
]
