"""Published results of the 36 reference runs (fixed values).

One row per result file: prep, model, the printed 2x2 matrix row by row
(m00 m01 / m10 m11), and the printed Precision (accuracy), TNR, TPR and
Resultado.  DT and RF files were printed from (label, prediction) pairs given
to a (prediction, label) API, so their matrix rows are predictions.
"""

GOLDEN = [
    ("FCNN", "bayes", 470596, 0, 528808, 0, 0.4708766424789174, 1.0, 0.0, 0.20477349288785296),
    ("FCNN", "dt", 433613, 334762, 36983, 194046, 0.6280333078514795, 0.5643247112412559, 0.8399205294573409, 0.4739879102516167),
    ("FCNN", "pcard", 455906, 14690, 417033, 111775, 0.5680195396456288, 0.9687842650596266, 0.21137161313747144, 0.20477349288785296),
    ("FCNN", "rf", 457815, 405416, 12781, 123392, 0.5815536059491457, 0.5303505087282546, 0.9061414524171458, 0.4805725802691928),
    ("HMDFILTER", "bayes", 470596, 0, 528808, 0, 0.4708766424789174, 1.0, 0.0, 0.006405881992240785),
    ("HMDFILTER", "dt", 468337, 487849, 2259, 40959, 0.5095997214339747, 0.4897969641889758, 0.9477301124531445, 0.4641953319500268),
    ("HMDFILTER", "pcard", 470524, 72, 525420, 3388, 0.47419461999351614, 0.9998470025244584, 0.006406862225987504, 0.006405881992240785),
    ("HMDFILTER", "rf", 470300, 517660, 296, 11148, 0.4817351141280203, 0.47603141827604356, 0.9741349178608878, 0.4637188265415356),
    ("NoPrepro", "bayes", 470596, 0, 528808, 0, 0.4708766424789174, 1.0, 0.0, 0.0),
    ("NoPrepro", "dt", 467464, 483415, 3132, 45393, 0.5131628450556531, 0.4916124974891653, 0.9354559505409583, 0.4598818361365416),
    ("NoPrepro", "pcard", 470596, 0, 528808, 0, 0.4708766424789174, 1.0, 0.0, 0.0),
    ("NoPrepro", "rf", 470596, 528798, 0, 10, 0.4708866484424717, 0.47088135410058496, 1.0, 0.47088135410058496),
    ("ROS100", "bayes", 263225, 207371, 252133, 276675, 0.5402219722954881, 0.5593438958257189, 0.5232050195912316, 0.4711605902585148),
    ("ROS100", "dt", 334997, 167113, 135599, 361695, 0.6971074760557292, 0.6671785067017187, 0.727326289880835, 0.4852564679675969),
    ("ROS100", "pcard", 333447, 137149, 177176, 351632, 0.6854875505801458, 0.7085631837074688, 0.664952118727402, 0.4711605902585148),
    ("ROS100", "rf", 340391, 160561, 130205, 368247, 0.7090606001176701, 0.6794882543636915, 0.738781266802019, 0.5019931933359005),
    ("ROS115", "bayes", 468, 470128, 82, 528726, 0.5295095877142777, 9.944835910207482e-4, 0.9998449342672577, 0.46065140002250066),
    ("ROS115", "dt", 314520, 147068, 156076, 381740, 0.6966752184301844, 0.6813868644765462, 0.709796659080429, 0.4836461199467415),
    ("ROS115", "pcard", 300467, 170129, 147284, 381524, 0.6823977090345846, 0.6384818400496391, 0.7214792514485409, 0.46065140002250066),
    ("ROS115", "rf", 310578, 129703, 160018, 399105, 0.7101062233090922, 0.7054085913314452, 0.7138053701958246, 0.5035244406746574),
    ("ROS140", "bayes", 0, 470596, 0, 528808, 0.5291233575210825, 0.0, 1.0, 0.420581844959597),
    ("ROS140", "dt", 279208, 115472, 191388, 413336, 0.6929570023734145, 0.707428803080977, 0.6835118169611261, 0.48353594656451326),
    ("ROS140", "pcard", 239495, 231101, 91789, 437019, 0.6769174427959064, 0.5089184778451156, 0.8264228226501869, 0.420581844959597),
    ("ROS140", "rf", 267050, 93195, 203546, 435613, 0.7030820368939888, 0.7413010590015129, 0.6815408998386943, 0.505226990803268),
    ("ROS150", "bayes", 0, 470596, 0, 528808, 0.5291233575210825, 0.0, 1.0, 0.3883833675136821),
    ("ROS150", "dt", 270635, 108780, 199961, 420028, 0.6910748806288548, 0.7132954680231409, 0.6774765358740236, 0.48324094273095786),
    ("ROS150", "pcard", 213164, 257432, 75396, 453412, 0.6669735162156646, 0.45296602606057, 0.8574227318800018, 0.3883833675136821),
    ("ROS150", "rf", 245689, 77799, 224907, 451009, 0.6971134796338618, 0.7594995795825502, 0.6672559903893384, 0.5067806441746406),
    ("ROS180", "bayes", 0, 470596, 0, 528808, 0.5291233575210825, 0.0, 1.0, 0.28285401816308375),
    ("ROS180", "dt", 227469, 78633, 243127, 450175, 0.6780481166775398, 0.7431150400846777, 0.6493202096633213, 0.4825196136317503),
    ("ROS180", "pcard", 143488, 327108, 38247, 490561, 0.6344271185626633, 0.3049069690350109, 0.9276731819488359, 0.28285401816308375),
    ("ROS180", "rf", 195303, 48016, 275293, 480792, 0.6764981929229821, 0.8026623486040959, 0.6358967576396833, 0.5104103849567978),
    ("RUS", "bayes", 268078, 202518, 254781, 274027, 0.5424282872592064, 0.5696563506702139, 0.5181975310509674, 0.47251331592717793),
    ("RUS", "dt", 332562, 169882, 138034, 358926, 0.6919003726220828, 0.6618886880926034, 0.7222432388924662, 0.4780446298742872),
    ("RUS", "pcard", 337977, 132619, 180893, 347915, 0.6863010354171086, 0.7181892748769645, 0.657923102524924, 0.47251331592717793),
    ("RUS", "rf", 338965, 159745, 131631, 369063, 0.7084502363408591, 0.6796835836458062, 0.7371029011731717, 0.5009967413851019),
]
