"""Hand-checked texts: True where half of the words or more stand in full sentences.

``CALIBRATION`` sets the probabilities; ``JUDGED`` is seen by nothing but the test.
"""

CALIBRATION: list[tuple[str, bool]] = [
    ("The strain was grown at 30 degrees and the signal was lost after two days. We think that the pump is not needed in this medium.", True),
    ("however the gene sits next to a transposon and is silent in most strains this is the reason why the record was not changed", True),
    ("- Cells without the factor stop dividing once the sugar runs out.\n- The authors propose that the term was gained twice in the lineage.", True),
    ("# Notes\n\nThis entry was merged with another one after the strain had been\nsequenced again. Please check the record before the term is copied\nto other strains.", True),
    ("<p>Beyond a distance of one half the scores tell us next to nothing.</p>\n<p>That result fits the view that the pathway depends on it.</p>", True),
    ("Das Protein ist in der Membran zu finden, aber es wird durch kein Experiment gestützt. Die Zellen wachsen auch ohne den Zucker.", True),
    ("die zellen wurden bei 30 grad gehalten und das signal war nach zwei tagen verschwunden wir danken den kuratoren für die hilfe", True),
    ("La estructura de la proteína muestra una cavidad en la que encaja el sustrato. Se necesitan más datos para confirmar que actúa en la membrana.", True),
    ("en las células la falta de este gen frena el crecimiento durante tres horas y el registro fue corregido por los curadores", True),
    ("Les auteurs pensent que la protéine est apparue tôt dans la lignée. On ne sait pas encore si elle intervient dans cette voie ou en dehors.", True),
    ("> Samples were kept on ice, spun at low speed and frozen.\n> None of the neighbours has experimental evidence for the term.", True),
    ("Growth assays gave a mean doubling time of 40 minutes (n = 19; p < 0.01; 7.99 ± 0.13 µM). The product is thought to take part in transport (n = 8; p < 0.05).", True),
    ("A closer look at the best neighbours shows that most of them carry the term, which may bias the transfer.\n\n| id | go |\n| FX1 | GO:1 |", True),
    ("We checked the hit by hand because the model was trained on few membrane proteins [4]. Reviewers asked us to remove it, and we agree with them [5].", True),
    ("accession\tgo_id\tdistance\nFX00001\tGO:9000001\t0.41\nFX00002\tGO:9000002\t0.22\nFX00003\tGO:9000007\t0.93", False),
    ("| accession | go_id | evidence |\n| FX00001 | GO:9000001 | IDA |\n| FX00002 | GO:9000002 | IEA |\n| FX00003 | GO:9000003 | ISS |", False),
    ("1. regulation of transport;\n2. kinase activity;\n3. positive regulation of storage;\n4. inner lumen;\n5. import into vesicle;", False),
    ("basal membrane\nreceptor activity\nnegative regulation of catabolic process\nouter envelope\nhydrolase activity\nexport from cell", False),
    ("2024-01-27 18:48:59 ERROR embed: batch=66 skipped empty layer. 58.45s\n2024-03-27 22:37:43 DEBUG store: batch=77 done 84.08s", False),
    ("-0.471 0.118 0.902 -0.333 0.264\n0.707 -0.058 -0.613 -0.245 -0.990", False),
    ("of strain the grown which and signal to two was after days lost that pump is in not medium the needed we this think when", False),
    ("Zellen der nicht und wurden bei auf das dem Signal Tagen war nach zwei Membran zu in die finden ist von Experiment kein", False),
    ("for x in items:\n    out.append((x, 0.25))\n    if not x: return out\nitems = out[3] + 52\nfor y in out:\n    y = items[1] + 42", False),
    ("Dop velkra immun storigal fep tavrinos. Quelpa driv onnesk hurlito bemva. Skarvin oltrep dunmage fisk lorvane ipta.", False),
    ("q8Zt1LxV0aPw93KdMRuYc5HsnEbJ7GoT\nWb2+Xk4rQ9vUfC1yLmZ7eAHsD6pN0tGj\nkV5oR3zBqS8wT1hYxUeM/4nCaJdLg2PF", False),
    ("[1] Brub G, Glof K. Membrane complex. J Zio 17:372-395.\n[2] Zyf A, Fla M. Cellular storage. J Plo 62:845-924.\n[3] Dio F, Tra B. Outer lumen. J Pek 43:653-742.", False),
    ("name: null\n  layer: [2, 34]\n    active: true\nmodel: Small\n  count: 769\n    values: [9, 5]", False),
    ("geneA=0.773, geneB=0.782, geneC=0.923, geneD=0.503, geneE=0.924, geneF=0.165, geneG=0.476", False),
    ("(((a:0.694,b:0.676):0.939,c:0.831):0.366,d:0.111):0.243,e:0.514);", False),
    ("The plot shows it.\n\n| FX00001 | GO:9000001 | IDA | membrane |\n| FX00002 | GO:9000002 | IEA | storage |\n| FX00003 | GO:9000003 | ISS | lumen |\n| FX00004 | GO:9000004 | ISS | body |", False),
    ("Home | About | Help for users | Contact | Log in | Back to the top | About | Terms of use | Help for users | Log in | Back to the top | Home", False),
    ("... --- *** ___ !!! ###", False),
    (">seq1\nMKTAYIAKQRQISFVKSHFSRQLEERLGLIEVQ\nAPILSRVGDGTQDNLSGAEKAVQVKVKALPDAQ", False),
]

JUDGED: list[tuple[str, bool]] = [
    ("After the second wash most of the label was gone, so we repeated the step with a milder buffer. The bands then looked as they should.", True),
    ("nobody has yet shown that the two subunits touch each other in the living cell but the model makes it look likely and we will test it next month", True),
    ("Why is this entry marked as reviewed? The evidence comes from a single screen, and the authors themselves say that it should be read with care.", True),
    ("1. The culture is kept in the dark until it turns yellow.\n2. It is then moved to the bench and left there for one night.\n3. In the morning the cells are counted by hand.", True),
    ("Dear all, the new release of the table is out. Please use it from today on, because the old one holds two wrong names that we had not seen before.", True),
    ("## Background\n\nIt had been known for years that the plant closes its pores at noon. What had not been known is which of the channels does the work.", True),
    ("The reading frame is short. It starts near the border of the segment and ends before the repeat, which is why the first search did not find it at all.", True),
    ("<div>When the sample is heated too fast, the protein falls out of solution.</div><div>We therefore warm it over an hour.</div>", True),
    ("I would not trust this hit, since its score is low and its neighbours disagree with each other on almost every term.", True),
    ("The donor was chosen by distance.\nIt is not the best one by sequence.\nWe kept it all the same, as the other had no annotation.\n\nid: X17\nscore: 0.3", True),
    ("Wir haben die Probe zweimal gemessen, weil der erste Wert nicht zu den anderen passte. Beim zweiten Mal lag er im erwarteten Bereich.", True),
    ("es ist noch nicht klar ob das enzym den zucker spaltet oder ihn nur bindet und deshalb bleibt der eintrag vorläufig ohne funktion", True),
    ("Die Blätter wurden am Morgen geerntet und in Eis gelegt. Danach hat man sie gemahlen, und der Saft ging durch ein feines Sieb.", True),
    ("> Das Modell findet viele Nachbarn, die nicht verwandt sind.\n> Man sollte daher auf die Länge der Sequenz achten, bevor man den Begriff übernimmt.", True),
    ("Warum fehlt hier die Quelle? Ich habe die Tabelle durchgesehen und keinen Hinweis gefunden, aus dem sie hervorgeht.", True),
    ("Zu diesem Thema gibt es nur wenige Arbeiten, und keine von ihnen hat die Mutante über mehr als einen Tag verfolgt.", True),
    ("El extracto se guardó en frío durante la noche y por la mañana ya no tenía actividad. Creemos que una proteasa lo había cortado.", True),
    ("no sabemos si la señal viene del núcleo o de la pared porque el colorante se une a las dos y el microscopio no las separa", True),
    ("Los autores no dicen de dónde salió la cepa. Sin ese dato es difícil repetir el ensayo, y por eso lo hemos dejado fuera de la lista.", True),
    ("¿Qué ocurre cuando se quita el gen? La planta crece más despacio, pero florece al mismo tiempo que las otras.", True),
    ("La tabla fue revisada a mano.\nSe quitaron los nombres que estaban dos veces.\nEl resto quedó como estaba.", True),
    ("Cette protéine a été vue dans les racines, mais on ne l'a pas encore trouvée dans les feuilles. Il faudra sans doute une autre méthode.", True),
    ("nous avons gardé les cellules dans le noir pendant une semaine et elles ont perdu leur couleur sans que leur nombre change", True),
    ("Le nom ancien reste dans la fiche parce que plusieurs bases s'en servent toujours. Il sera retiré quand elles auront changé.", True),
    ("- Si le milieu est trop acide, la croissance s'arrête.\n- Elle reprend dès que l'on ajoute un peu de base.\n- Le gène n'y est pour rien.", True),
    ("Pourquoi la distance est-elle si grande ici ? Les deux séquences ne se ressemblent que sur la moitié de leur longueur.", True),
    ("tray;position;species;weight_mg;date\n1;A1;sp1;12.4;2023-02-11\n1;A2;sp1;11.9;2023-02-11\n1;A3;sp2;30.2;2023-02-12", False),
    ("| sample | ct | mean |\n|---|---|---|\n| s1 | 22.4 | 22.6 |\n| s2 | 25.0 | 24.8 |\n| s3 | 19.7 | 19.7 |", False),
    ("buffers\nsalts\npipette tips\nfilter paper\ngloves\nethanol\nagar plates\nloading dye\nladder", False),
    ("* membrane transport\n* cell division\n* signal transfer\n* stress response\n* metal binding\n* repair of DNA", False),
    ("Puffer\nSalze\nHandschuhe\nFilterpapier\nAgarplatten\nLadepuffer\nPipettenspitzen\nEthanol", False),
    ("guantes; puntas; etanol; papel de filtro; placas de agar; colorante de carga; sales; tampones", False),
    ("gants, pointes, éthanol, papier filtre, boîtes de gélose, colorant de charge, sels, tampons, tubes, rubans", False),
    ("2021-11-03T04:12:55Z worker-7 INFO fetched 118 rows in 0.42s\n2021-11-03T04:12:56Z worker-7 WARN retry 2 of 5\n2021-11-03T04:12:59Z worker-7 INFO done", False),
    ("SELECT a.id, b.name FROM a JOIN b ON a.id = b.id WHERE b.score > 0.5 GROUP BY a.id, b.name ORDER BY 2;", False),
    ("{\"id\": 17, \"terms\": [\"T:1\", \"T:9\"], \"score\": 0.31, \"parent\": null, \"tags\": {\"a\": 1, \"b\": 2}}", False),
    ("def f(a, b=2):\n    c = [x * b for x in a if x > 0]\n    return sum(c) / len(c)\n\nprint(f([1, 2, 3]))", False),
    ("0.12 0.55 0.91 1.33\n0.14 0.52 0.88 1.40\n0.11 0.57 0.93 1.29\n0.15 0.50 0.90 1.31", False),
    ("A0A1B2 C3D4E5 F6G7H8 I9J0K1 L2M3N4 O5P6Q7 R8S9T0 U1V2W3 X4Y5Z6", False),
    ("MSTNPKPQRKTKRNTNRRPQDVKFPGGGQIVGGVYLLPRRGPRLGVRATRKTSERSQPRGRRQPIPKARRPEGRTWAQPGYPWPLYG", False),
    ("Smith J, Doe A (2011) Plant pores. J Bot 12:1-9. Lee K (2014) Ion flow. Cell Rep 3:88-91. Ito M, Sato R (2017) Noon. Nat Leaf 5:2.", False),
    ("Menu Search Login Cart Help Terms Privacy Contact Menu Search Login Cart Help Terms Privacy Contact Menu Search", False),
    ("error error error error error error error error error error error error error error error error error error error error", False),
    ("a=1; b=2; c=3; alpha=0.05; beta=0.2; gamma=17; delta=0.001; eps=1e-9; zeta=4; eta=5", False),
    ("when was the so label gone wash second after most milder the buffer a with step repeated we the bands should they as looked then", False),
    ("weil nicht den der Wert passte zu erste anderen gemessen haben zweimal die wir Probe lag Bereich er im beim Mal zweiten", False),
    ("frío en guardó se noche la durante extracto el y tenía mañana no la por actividad ya que una creemos proteasa cortado había", False),
    ("orvel stip nakkuro femd alsivar. Trunno pexil dasfe wuto merl! Givvan osteki rump, dalfe quin orbast teggo.", False),
    ("chr1 1000 2000 + geneX\nchr1 2500 2900 - geneY\nchr2 100 450 + geneZ\nchr2 700 990 - geneW", False),
    ("The table is below.\n\nx1\t0.4\tyes\nx2\t0.7\tno\nx3\t0.1\tyes\nx4\t0.9\tyes\nx5\t0.2\tno\nx6\t0.3\tno\nx7\t0.8\tyes", False),
    ("§§ %% ~~ ^^ && || <> == ++ -- // ::", False),
]
