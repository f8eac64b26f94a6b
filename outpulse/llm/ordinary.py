"""Ordinary words of prose and code, which the secret scan takes for explained."""

from __future__ import annotations

WORDS = (
    "abc about above abs absolute abstract accept accepted access accessed accommodation according accumulators accuracy "
    "acknowledgement action active actual actually add added adding addition additional additionally admin administration administrator "
    "advertisement after again against aggregate aggregation agreed agreement agreements algorithm algorithms alias all allow allowed "
    "allowing allows already also alternative alternatively always ambiguous analysis and annotation annotations announcement another "
    "any anything apache api app appear append appended applicable application applications applied apply applying approach appropriate "
    "approval approximate approximately arbitrary are arg argparse args argument arguments argv arithmetic array arrow ascending ascii "
    "assert assigned assignment associated assume assuming attached attempt attempts attr attribute attributes auth authenticated "
    "authentication authorisation authorized automatically available avoid back backward backwards bar base based basename basic batch "
    "bearer because been before beginning behavior behaviour being below better between bin binary bit block blocking bool boolean "
    "bootstrap both bound boundaries boundary break breaking broadcast buffer build builder building built builtin builtins but byte "
    "bytes cache cached calculate calculated calculating calculation call callable callback called caller calling calls can cannot case "
    "cases cast categorical categories category cause cert certs chain change changed changing char character characteristic characters "
    "chdir check checking checkpoint checks child children circumstances class classes classification clear client close closed cls "
    "clustering coalesce code codec codecs coefficients col collect collected collection collections cols column columns com "
    "combination combinations combined command commands comments common communication compared comparing comparison comparisons "
    "compatibility compatible compile compiled compiler complete completed completion compliance component components compression "
    "computation compute computed computes computing concurrent condition conditional conditions conf config configuration configure "
    "configured connect connected connection consecutive consider consideration considered consistency consistent consists constant "
    "constants constitutional construct constructed constructor constructs consumed contain contained container containing contains "
    "content contents context continue continuous contributor control controls convenience conversation conversion convert converted "
    "converter converting converts cookie copy copyright core coroutine correct correctly correlation corresponding corresponds could "
    "count create created creates creating creation credential credentials csrf cumulative current currently custom data database "
    "dataclass dataset datasets datasource date datetime debugging decimal decode decoder decoding decorator def default defaults "
    "define defined definition del delete delimited delimiter dense dependencies dependency dependent depending deprecated descending "
    "describe described describing description descriptor deserialize deserialized deserializer designed detailed details determine "
    "determined determines deterministic development deviation dict dictionaries dictionary difference differences different "
    "differently digest dimensional dimensions dir direction directly directories directory disable disabled display distance distinct "
    "distribute distributed distribution division doc docs docstring doctest doctests document documentation documented does doesn don "
    "done double down drop dtype dump dumps duplicate duplicated duplicates duration during each efficient efficiently either element "
    "elements elif else embedded empty enable enabled encode encoded encoder encoding encodings encountered end endswith ensure enter "
    "entertainment entries entry enumerate environ environment environmental equal equality equivalent error errors escape especially "
    "establishment estimate estimator etc evaluate evaluated evaluates evaluation evaluator even event eventually every everything "
    "exactly example examples exc except exception exceptions excluding exclusive exec executable execute executed executing execution "
    "executor executors exist existing exists exit expanded expected expensive experimental expires expiry explicit explicitly expr "
    "express expression expressions extend extended extension extensions external extra extract extraordinary fail failed fails failure "
    "failures fallback false feature features field fields file filename filenames files filesystem filter filtered filtering final "
    "finally find finished first fit fix fixed flag flags float floating flush followed following foo for form format formatted "
    "formatter formatting found foundation fraction fractions frame frames free frequencies frequency from full fullname func function "
    "functionality functions functools future gateway generally generate generated generates generator generic get getattr getitem gets "
    "given global globals globs got governing government group grouping groups guarantee guaranteed handle handler handlers handling "
    "has hasattr hash hashable have header headers help helper here hmac hostname how however html http https identical identified "
    "identifier identifiers identify identity ignore ignored ignoring immediately immutable impersonation implement implementation "
    "implementations implemented implementing implements implied import important imported importing importlib include included "
    "includes including inclusive incompatible incorrect increasing independent index indexing indicate indicates indicating indicator "
    "indices individual inference inferred info information infrastructure inherit inherited inherits init initial initialization "
    "initialize initialized input insensitive insert inside inspect installed instance instances instantiate instead int integer "
    "integers intended interactive intercept interface intermediate internal internally international interpreted interpreter "
    "intersection interval into invalid investigation invoking issue item items iter iterable iteration iterations iterator itertools "
    "its itself java join json just jvm jwt keep key keys keyword keywords know known kwargs label labels lambda language large last "
    "later law learning least left len length less level lib libraries library license licenses like limit limitations linalg line "
    "lines list lists lit literal literals load loaded loads local localhost location log login logout long look lower main mainloop "
    "make management manager manually manufacturing many map mapping mappings master match matches matching max maximum may mean means "
    "mechanism memory memoryview merge message messages meta metadata meth method methods microseconds might milliseconds min minimum "
    "mismatch missing mixin mllib mod mode model modification modified modify module modules more most msg multi multiple "
    "multiplication multiply multiprocessing must name named names namespace nan ndarray necessary need needed needs negative "
    "neighbourhood nested never nevertheless new next non nonce none nonlocal noqa normal normalize normalized normally not note notes "
    "nothing now null nullable num number numbers numeric numerical numpy oauth obj object objects observation observations obtain "
    "occurred occurrence occurrences off offset old once one only open operating operation operations operator operators opportunity "
    "ops optimization optimize optimized optimizer option optional optionally options order ordering org organisation organizations "
    "original other otherwise our out output over overhead overload overridden override overrides overriding overwrite ownership "
    "package packages pair pairs pandas parallel parallelism parallelize param parameter parameters params parent parse parsed parser "
    "part partial partially participation particular partition partitioned partitioning partitions parts pass passed passwd password "
    "path pathname paths pattern patterns per perform performance performed performs permission permissions phrase pickle pickling "
    "pipeline pipelines place plan platform platforms please point points pop pos position positional positions positive possibility "
    "possible possibly potential potentially practice precedence precision predicate predicted prediction predictions preferred prefix "
    "present preserve preserved previous previously primitive print printable printing priority private probabilities probability "
    "probably process processed processes processing produced professional profiler progress propagate properly properties property "
    "proto protocol provide provided provides providing proxy public purposes pwd pyarrow pyspark python qualified quantile query raise "
    "raised raises random range rather raw rdd read readable reader reading readline real reason received recent recognize recognized "
    "recommendation recommended record recursion recursive recursively reduce reduction reference referenced references refresh "
    "regarding regardless register registered registration registry regression regular related relation relationship relative releases "
    "relevant remainder remaining remote remove removed removing replace replaced replacement replaces replacing repr represent "
    "representation representative represented representing represents request requested requests require required requires reserved "
    "reset resolution resolved resource resources respectively response responsibility responsible result resulting results return "
    "returned returning returns reversed revolutionary right root row rows run running runtime safe salt same sample sampling save "
    "scalar schema search searched searching second seconds secret secrets see seed select selected selection self semantics send "
    "sensitive sep separate separated separately separator separators sequence sequences sequential ser serializable serialization "
    "serialize serialized serializer serializers series server session set sets setting settings setup shared short should show "
    "shutdown side sign signature signed significant similar similarly simple simply since single size skip small socket software some "
    "something sometimes sort sorted source space spark spec special specific specifically specification specified specifies specify "
    "specifying split splitext sql src stack standard start starting starts stat state statement statements statistical statistics "
    "status stderr stdout step still stop storage store stored str stream streaming strftime strict strictly string strings strip "
    "stripped struct structure structured sub subclass subclasses submit subprocess subscription subsequent substitute subtract "
    "successfully such suitable sum summary super supplied support supported supporting supports supposed suppress sure sys system "
    "table take takes target tell temp tempfile temporarily temporary terminal terminate terminated test testing testmod tests text "
    "than that the their them then there therefore these they this those thread threading three threshold through time timeout times "
    "timestamp timestamps timezone tmp together token tokens tolerance too top total traceback traditional trailing train training "
    "transfer transform transformation transformed transformer transforms translate transportation transpose treated tree true truncate "
    "truncated try tuple tuples two txt type types typically typing udf unchanged undefined under underlying understanding unexpected "
    "unfortunately unicode union unique university unix unknown unless unnecessary unsupported until update updated updating upper "
    "usage use used useful user users uses using utf util utilities utils val valid validate validation value values var variable "
    "variables variance vault vector vectors verification version versions vertical very via view wait want warn warning warnings was "
    "way weighted well were what whatever when whenever where whether which while whitespace whose wikipedia will window windows with "
    "within without word words work worker works would wrap wrapped wrapper wrapping wraps writable write writer writing written www "
    "yet yield you your zero zip"
)

#: Words of other languages, for their letters only.
GERMAN = (
    "und der die das nicht eine einen werden wurde haben sich auch nach wenn zwischen durch gegen Geschwindigkeit "
    "Begrenzung Wirtschaft Gesellschaft Entwicklung Bundesregierung Verantwortung Zusammenarbeit Versicherung Krankenhaus "
    "Wissenschaft Möglichkeit Veränderung Unternehmen Mitarbeiter Geschäftsführer Bürgermeister Veranstaltung Ausbildung "
    "Einrichtung Verwaltung Landwirtschaft Freundschaft Nachbarschaft Gewerkschaft Eigenschaft Öffentlichkeit "
    "Schwierigkeit Aufmerksamkeit Abhängigkeit Arbeitslosigkeit Persönlichkeit Gerechtigkeit Sicherheit Krankheit "
    "Gesundheit Wahrscheinlichkeit Verständnis Ergebnis Verhältnis Gedächtnis Bedürfnis Reichtum Wachstum Eigentum "
    "Schmetterling Frühling Zeitung Rechnung Wohnung Kreuzung Meinung Hoffnung Erfahrung Erinnerung Entscheidung "
    "Unterscheidung Bedeutung Bewegung Beziehung Erklärung Forschung Herstellung Vorstellung Leistung Lieferung Prüfung "
    "Richtung Sammlung Steuerung Überraschung Umgebung Vermittlung Zerstörung Straßenbahn Flughafen Schriftsteller "
    "Zeitschrift Buchhandlung Taschenbuch Wörterbuch Handschuh Kühlschrank Schlafzimmer Kindergarten Hauptbahnhof "
    "Wochenende Geburtstag Weihnachten selbstverständlich wahrscheinlich außergewöhnlich grundsätzlich hauptsächlich "
    "durchschnittlich unterschiedlich verschiedene zusätzlich tatsächlich freundlich gesellschaftlich wirtschaftlich "
    "wissenschaftlich landwirtschaftlich beziehungsweise möglicherweise glücklicherweise normalerweise"
)

FRENCH = (
    "les des une pour dans avec sur pas plus vous nous être avoir faire comme mais gouvernement développement "
    "établissement environnement fonctionnement changement renseignement enseignement commencement remerciement "
    "appartement département événement investissement information organisation administration communication construction "
    "production réalisation utilisation situation population éducation considération représentation transformation "
    "participation connaissance naissance croissance importance indépendance correspondance expérience conséquence "
    "différence préférence existence intelligence université responsabilité possibilité activité qualité société réalité "
    "sécurité bibliothèque médicament bâtiment boulangerie librairie entreprise travailleur utilisateur ordinateur "
    "consommateur chercheur malheureusement heureusement certainement probablement particulièrement généralement "
    "évidemment rapidement actuellement complètement simplement notamment aujourd maintenant quelquefois longtemps "
    "beaucoup pourquoi lorsque cependant pourtant toujours parallèlement professionnel exceptionnel traditionnel "
    "international nécessaire extraordinaire vocabulaire anniversaire propriétaire merveilleux dangereux nombreuses "
    "magnifique automatique électronique mathématiques scientifique démocratique politique économique historique "
    "catastrophe philosophie photographie chaussures fenêtre champignon montagne"
)

SPANISH = (
    "los las una por para con que del como más pero sus este entre desde hasta sobre también gobierno desarrollo "
    "establecimiento conocimiento funcionamiento crecimiento nacimiento agradecimiento departamento pensamiento movimiento "
    "información organización administración comunicación construcción producción realización utilización situación "
    "población educación consideración representación transformación participación importancia independencia "
    "correspondencia experiencia consecuencia diferencia preferencia existencia inteligencia universidad responsabilidad "
    "posibilidad actividad calidad sociedad realidad seguridad biblioteca medicamento edificio panadería librería empresa "
    "trabajador ordenador consumidor investigador desafortunadamente afortunadamente ciertamente probablemente "
    "particularmente generalmente evidentemente rápidamente actualmente completamente simplemente especialmente "
    "ayuntamiento siempre mientras aunque todavía después entonces profesional excepcional tradicional internacional "
    "necesario extraordinario vocabulario aniversario propietario maravilloso peligroso numerosas magnífico automático "
    "electrónico matemáticas científico democrático política económica histórica catástrofe filosofía fotografía zapatos "
    "ventana montaña desgraciadamente ferrocarril cumpleaños aparcamiento rascacielos lavavajillas paraguas murciélago "
    "guardarropa agricultura arquitectura literatura temperatura"
)
